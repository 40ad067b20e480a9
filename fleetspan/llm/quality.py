"""Quality scores by gated attention over the passages of a text.

A text is a bag of passages of 128 words (an empty one is one empty passage).
Every passage is described by its own figures (kinds of bytes, word lengths,
variety, repeats) and encoded by a small layer; an attention weight from a tanh
gate times a sigmoid gate, normalized over the bag, mixes the encodings, and the
mixture is scored. Only documents are labelled; which passages matter is learnt.

The model is trained with Adam on at most ``sample`` labelled documents, those
with the smallest hashes of their ids. Spark describes the passages; the driver
holds a few numbers for each passage of the sample. Scoring sees all passages of
all texts. Labels, language, source and id are no inputs.

Nulls and empty texts get the score of an empty passage. Repeated rows get equal
scores. Labels that are null, or that an id has more than once and unequal, are
not learnt from; with labels of one class only, every score is that class's share.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.words import BASE, LOWER, SMALL_PIECE, mixed, pieces, run_hashes, words_of
from fleetspan.plans.shared import staged

PASSAGE = 128
SAMPLE = 6000
"""Labelled documents to learn from, at most."""
THRESHOLD = 0.7
STEPS = 400
_KINDS = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "stop": b".,;:'\"-()\n ",
    "mark": b"!?",
    "sign": b"#$%&*+/<=>@[\\]^_`{|}~",
    "wide": range(128, 256),
}
FEATURES = [*_KINDS, "length", "spread", "variety", "next", "again", "capital", "words", "empty", "longest", "signed", "shout"]


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Figures of every passage, and where each text's passages begin."""
    words = words_of(texts)
    n_words = np.diff(words.first)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    bounds = np.append(0, np.cumsum(n_passages))
    total = int(bounds[-1])
    x = np.zeros((total, len(FEATURES)))
    at = {name: i for i, name in enumerate(FEATURES)}
    passage = bounds[words.doc] + (np.arange(len(words.start)) - words.first[words.doc]) // PASSAGE
    full = np.flatnonzero(np.bincount(passage, minlength=total)) if len(passage) else np.zeros(0, int)
    empty = np.ones(total, bool)
    empty[full] = False
    x[empty, at["empty"]] = 1
    if not len(full):
        return x, bounds
    head = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    tail = np.append(head[1:], len(passage))
    count = (tail - head).astype(float)
    length = (words.end - words.start).astype(float)
    size = np.add.reduceat(length, head)
    per_word = {}
    for name, codes in _KINDS.items():
        sums = np.append(0, np.cumsum(np.isin(np.arange(256), list(codes))[words.data], dtype=np.int64))
        per_word[name] = sums[words.end] - sums[words.start]
        x[full, at[name]] = np.add.reduceat(per_word[name], head) / size
    x[full, at["length"]] = size / count / 10
    x[full, at["spread"]] = np.sqrt(np.maximum(0, np.add.reduceat(length**2, head) / count - (size / count) ** 2)) / 10
    x[full, at["longest"]] = np.log1p(np.maximum.reduceat(length, head)) / 5
    x[full, at["words"]] = count / PASSAGE
    first_byte = words.data[words.start]
    x[full, at["capital"]] = np.add.reduceat((first_byte >= 65) & (first_byte < 91), head, dtype=float) / count
    x[full, at["signed"]] = np.add.reduceat(per_word["sign"] > 0, head, dtype=float) / count
    x[full, at["shout"]] = np.add.reduceat((per_word["upper"] > 1) & (per_word["lower"] == 0), head, dtype=float) / count
    words.data = LOWER[words.data]
    value = words.hashes()
    inside = mixed(value ^ (passage.astype(np.uint64) * BASE))
    new = np.zeros(len(value), bool)
    new[np.unique(inside, return_index=True)[1]] = True
    x[full, at["variety"]] = np.add.reduceat(new, head, dtype=float) / count
    twin = np.append(False, (value[1:] == value[:-1]) & (words.doc[1:] == words.doc[:-1]))
    x[full, at["next"]] = np.add.reduceat(twin, head, dtype=float) / count
    runs = words.run_starts(4)
    if len(runs):  # runs of four words that the document has had before
        key = mixed(run_hashes(value, runs, runs + 4) ^ (words.doc[runs].astype(np.uint64) * BASE))
        old = np.ones(len(runs), bool)
        old[np.unique(key, return_index=True)[1]] = False
        again = np.zeros(len(value))
        again[runs] = old
        x[full, at["again"]] = np.add.reduceat(again, head) / count
    return x, bounds


@dataclass
class AttentionModel:
    """Weights of the encoder, the two gates, the attention and the score."""

    shift: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]
    constant: float | None = None

    @staticmethod
    def _forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray):
        h = np.tanh(x @ p["encode"] + p["encode_0"])
        gate_1, gate_2 = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-(h @ p["sigmoid"])))
        logit = (gate_1 * gate_2) @ p["attend"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        weight = np.exp(logit - np.maximum.reduceat(logit, first[:-1])[bag])
        weight /= np.add.reduceat(weight, first[:-1])[bag]
        z = np.add.reduceat(weight[:, None] * h, first[:-1])
        return h, gate_1, gate_2, bag, weight, z, 1 / (1 + np.exp(-(z @ p["score"] + p["score_0"])))

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        if len(first) < 2:
            return np.zeros(0)
        return self._forward(self.parts, (x - self.shift) / self.scale, first)[-1]

    @classmethod
    def fit(cls, x: np.ndarray, first: np.ndarray, label: np.ndarray, hidden: int = 16, gates: int = 8, steps: int = STEPS, seed: int = 7) -> "AttentionModel":
        """Minimize the mean logistic loss over the bags, with a little weight decay."""
        shift, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
        if len(set(label)) < 2:
            return cls(shift, scale, {}, float(label.mean()) if len(label) else 0.5)
        rng = np.random.default_rng(seed)
        x = (x - shift) / scale
        small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        p = {"encode": small(x.shape[1], hidden), "encode_0": np.zeros(hidden), "tanh": small(hidden, gates), "sigmoid": small(hidden, gates), "attend": small(gates), "score": small(hidden), "score_0": np.zeros(())}
        mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            h, g1, g2, bag, w, z, y = cls._forward(p, x, first)
            d_y = (y - label) / len(label)
            d_z = d_y[:, None] * p["score"]
            d_w = (h * d_z[bag]).sum(1)
            d_logit = w * (d_w - np.add.reduceat(w * d_w, first[:-1])[bag])
            d_gate = d_logit[:, None] * p["attend"]
            d_1, d_2 = d_gate * g2 * (1 - g1**2), d_gate * g1 * g2 * (1 - g2)
            d_h = (w[:, None] * d_z[bag] + d_1 @ p["tanh"].T + d_2 @ p["sigmoid"].T) * (1 - h**2)
            grad = {"encode": x.T @ d_h, "encode_0": d_h.sum(0), "tanh": h.T @ d_1, "sigmoid": h.T @ d_2, "attend": (g1 * g2).T @ d_logit, "score": z.T @ d_y, "score_0": d_y.sum()}
            for k in p:
                grad[k] = grad[k] + 1e-4 * p[k]
                mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - 0.02 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return cls(shift, scale, p)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learnt from: a quarter, by a checksum of the id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, most=SMALL_PIECE):
        x, bounds = passage_features(piece.column("text"))
        n = np.diff(bounds)
        lists = pa.ListArray.from_arrays(pa.array((bounds * len(FEATURES)).astype(np.int32)), pa.array(x.reshape(-1)))
        yield pa.record_batch([piece.column("doc_id"), piece.column("label"), pa.array(n, pa.int64()), lists], names=["doc_id", "label", "n", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel:
    """Fit on a bounded sample of the documents (doc_id, text) that have one label (doc_id, label)."""
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other and label in (0, 1)")
    here = docs.select("doc_id").where(F.col("doc_id").isNotNull()).where(~held_out()).distinct()
    chosen = staged(known.select("doc_id", "label").join(here, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "sample")
    bodies = docs.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    bodies = bodies.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = bodies.mapInArrow(_passages, "doc_id long, label int, n long, x array<double>").toPandas().sort_values("doc_id")
    if rows.empty:
        return AttentionModel.fit(np.zeros((0, len(FEATURES))), np.zeros(1, int), np.zeros(0))
    x = np.concatenate(rows["x"].to_list()).reshape(-1, len(FEATURES))
    return AttentionModel.fit(x, np.append(0, np.cumsum(rows["n"])), rows["label"].to_numpy(float))


def _scores(model: AttentionModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, most=SMALL_PIECE):
            score = model.scores(*passage_features(piece.column("text")))
            rest = [c for c in piece.schema.names if c != "text"]
            yield pa.record_batch([*(piece.column(c) for c in rest), pa.array(score, pa.float64())], names=[*rest, "score"])

    return run


def quality_scores(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    model = train(docs, labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")), sample)
    scored = docs.mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least the threshold, with all columns."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    model = train(docs, labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, SMALL_PIECE):
            keep = model.scores(*passage_features(piece.column(piece.schema.get_field_index(text)))) >= threshold
            yield piece.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
