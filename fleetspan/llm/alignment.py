"""Alignment of two tokenizers over the same texts, and how often their tokens meet.

Both tokenizers cut ``blank + text``. The ends of the tokens in bytes go into a dictionary
from end to index for either side; the ends that both have are the intersection of the
keys. In their order they slice both id lists into groups, and inside a group
every two tokens whose bytes overlap are linked.

A blank between two characters that aren't white space always begins a token on both sides,
and nothing before it changes what follows, so a text is aligned by the parts between such
blanks. Parts that come again are answered from a bounded cache. Where a part's bytes don't
come back from its tokens, the whole text is tokenized and compared as one.

Counts of id pairs are needed over the whole corpus and again in every document. A pair is
so frequent that documents are not joined to it: a block of documents (``BLOCK_BYTES`` of
text) numbers its different pairs, adds up each once, and only these sums are counted, compared and
joined. They come back to their block, where each document's links (numbers and how
often, packed) are looked up. So a pair has at most one row a block, and a document
travels once.

Texts that are null or empty, or that the tokens of either side don't give back, have no tokens:
counts of zero and an empty digest. Repeated rows count as often as they stand there.
An empty table gives an empty result; other columns, clashing names included, are not looked at.
Texts of any length are aligned whole; a single document is held in memory.
"""

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.encoding import byte_letters
from fleetspan.llm.token_counts import BLANK, MODEL, model_bytes
from fleetspan.llm.words import pieces
from fleetspan.plans.shared import staged

TOKENIZER = "byte_bpe_50k.json"
BLOCK_BYTES = 32_000_000
KEPT, KEPT_BYTES = 400_000, 100_000_000
"""Parts in the cache at most, and bytes of their groups."""
TOGETHER = 256
"""Parts that are tokenized as one text."""
_PARTS = re.compile(r" (?<=\S )(?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def groups(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Ends that both sides have, and for each the number of tokens up to it on either side."""
    index_a = {end: i for i, end in enumerate(ends_a, 1)}
    index_b = {end: i for i, end in enumerate(ends_b, 1)}
    common = sorted(index_a.keys() & index_b.keys())
    return common, [index_a[end] for end in common], [index_b[end] for end in common]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each overlap of two tokens ends, and the two tokens; two that overlap share one stretch, so the slices'
    links are the stretches between ends of either side."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class _Grown:
    """An array that rows are added to."""

    def __init__(self, shape: tuple[int, ...], kind):
        self.rows, self.n = np.zeros((1024, *shape), kind), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.rows):
            self.rows = np.concatenate([self.rows[: self.n], np.zeros((self.n + 2 * len(rows), *self.rows.shape[1:]), self.rows.dtype)])
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Aligner:
    """Two tokenizers, the parts aligned so far, and a numbering of the id pairs seen."""

    def __init__(self, first: bytes, second: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_str(first.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        value = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t.content for t in self.first.get_added_tokens_decoder().values()}
        vocabulary = {i: t for t, i in self.first.get_vocab().items()}
        self.bytes_a = [self._token(vocabulary.get(i, ""), special, value) for i in range(max(vocabulary) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        if any(b" " in p.lstrip(b" ") for p in self.bytes_b):
            raise ValueError("a piece of this model spans words")
        self._size_a, self._size_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self._names = np.array([f"{i}{mark}" for side, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for mark in marks for i in range(len(side))], object)
        self.number: dict[int, int] = {}
        self.forget()

    @staticmethod
    def _token(token: str, special: set[str], value: dict[str, int]) -> bytes:
        return token.encode() if token in special else bytes(map(value.__getitem__, token))

    def _piece(self, i: int) -> bytes:
        if self.second.is_byte(i):
            return bytes.fromhex(_BYTE.fullmatch(self.second.id_to_piece(i))[1])
        return self.second.id_to_piece(i).replace(BLANK, " ").encode()

    def forget(self) -> None:
        """Drop all parts; the pairs keep their numbers."""
        self.place: dict[str, int] = {}
        self.lines: list[str] = []
        self.held = 0
        self.counts, self.first_link, self.pairs = _Grown((4,), np.int64), _Grown((), np.int64), _Grown((), np.int32)

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for whole texts."""
        first = self.first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [(a.ids, b) for a, b in zip(first, self.second.encode(texts, num_threads=1), strict=True)]

    def given_back(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether the tokens of both sides join to a blank and the text."""
        raw = b" " + text.encode()
        return b"".join([self.bytes_a[i] for i in ids_a]) == raw and b"".join([self.bytes_b[i] for i in ids_b]) == raw

    def align(self, parts: list[str]) -> None:
        """Give each part a place, -1 if its tokens don't give it back."""
        plain = [p for p in parts if not (p[0].isspace() or p[-1].isspace())]
        runs = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        runs += [[p] for p in parts if p[0].isspace() or p[-1].isspace()]
        good, ids_a, ids_b = [], [], []
        self.place.update(dict.fromkeys(parts, -1))
        for run, (a, b) in zip(runs, self.tokens([" ".join(r) for r in runs]), strict=True):
            whole = self.given_back(" ".join(run), a, b)
            for part, (a, b) in [(run, (a, b))] if whole else zip(([p] for p in run), self.tokens(run), strict=True):
                if whole or self.given_back(part[0], a, b):
                    good += part
                    ids_a += a
                    ids_b += b
        if good:
            self.place.update(zip(good, range(len(self.lines), len(self.lines) + len(good)), strict=True))
            self._add(good, np.array(ids_a, np.int64), np.array(ids_b, np.int64))

    def _add(self, parts: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Keep groups and links of parts whose tokens stand behind each other in a and b."""
        ends_a, ends_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        last = np.cumsum([1 + len(p.encode()) for p in parts])  # where each part ends
        common, to_a, to_b = map(np.array, groups(ends_a.tolist(), ends_b.tolist()))
        # Names with what stands behind them, a group's tokens of one side before those of the other.
        side = len(self.bytes_a)
        a_name, b_name = a.copy(), b + 2 * side
        a_name[to_a - 1] += side
        b_name[to_b - 1] += len(self.bytes_b)
        sizes_a, sizes_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        order = np.zeros(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(to_b - sizes_b, sizes_a)] = a_name
        order[np.arange(len(b)) + np.repeat(to_a, sizes_b)] = b_name
        names = self._names[order].tolist()
        ends, i, k = links(ends_a, ends_b)
        codes, at = np.unique(a[i] << 32 | b[k], return_inverse=True)
        number = self.number
        pairs = np.array([number.setdefault(c, len(number)) for c in codes.tolist()], np.int32)[at]
        n_a, n_b, n_groups, n_links = (np.searchsorted(x, last, side="right") for x in (ends_a, ends_b, common, ends))
        bounds = [0, *(n_a + n_b).tolist()]
        self.lines += ["".join(names[x:y])[:-1] for x, y in zip(bounds, bounds[1:], strict=False)]
        self.held += sum(map(len, self.lines[-len(parts) :]))
        self.counts.add(np.diff(np.stack([n_a, n_b, n_groups, n_links], axis=1), axis=0, prepend=0))
        self.first_link.add(self.pairs.n + np.concatenate([[0], n_links[:-1]]))
        self.pairs.add(pairs)

    def documents(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
        """For each text the numbers of tokens on both sides, groups and links, the groups as text, and each link's pair."""
        split = [_PARTS.split(t) if t else [] for t in texts]
        wanted = set().union(*split)
        if len(self.place) + len(wanted) > KEPT or self.held > KEPT_BYTES:
            self.forget()
        self.align([p for p in wanted if p not in self.place])
        for text, parts in zip(texts, split, strict=True):
            places = list(map(self.place.__getitem__, parts))
            if -1 in places:
                self.align([text])
                places = [p for p in [self.place.pop(text)] if p >= 0]
            at = np.array(places, np.int64)
            counts = self.counts.rows[at]
            n = counts[:, 3]
            link = np.arange(n.sum()) + np.repeat(self.first_link.rows[at] - np.cumsum(n) + n, n)
            yield counts.sum(axis=0), ";".join(map(self.lines.__getitem__, places)), self.pairs.rows[link]


@lru_cache(1)
def _aligner(first: bytes, second: bytes) -> Aligner:
    return Aligner(first, second)


def pack(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Rising numbers and how often each stands, small."""
    both = np.concatenate([np.diff(numbers, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(raw.T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
_ROWS = f"block long, {_DOCUMENT}, pair int, a int, b int, n long"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def _rows(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    filled = [columns[c] if c in columns else pa.nulls(n, kinds[t]) for c, t in (c.split() for c in _ROWS.split(", "))]
    return pa.record_batch(filled, names=_NAMES)


def _blocks(first: bytes, second: bytes, block_bytes: int):
    """Documents with their packed links, and each block's pairs: two kinds of rows, the latter with a ``pair``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(first, second)
        block, size, sums = TaskContext.get().partitionId() << 24, 0, np.zeros(0, np.int64)

        def close() -> pa.RecordBatch:
            pair = np.flatnonzero(sums)
            code = np.fromiter(tool.number, np.int64, len(tool.number))[pair]
            columns = {"block": np.full(len(pair), block), "pair": pair.astype(np.int32), "a": (code >> 32).astype(np.int32), "b": (code & 0xFFFFFFFF).astype(np.int32), "n": sums[pair]}
            return _rows({c: pa.array(v) for c, v in columns.items()}, len(pair))

        for batch in pieces(batches):
            if size >= block_bytes:
                yield close()
                block, size, sums = block + 1, 0, np.zeros(0, np.int64)
                if len(tool.number) > 10 * KEPT:  # parts hold these numbers
                    tool.number = {}
                    tool.forget()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            size += sum(map(len, texts))
            counts, digests, packed = [], [], []
            for count, line, pairs in tool.documents(texts):
                counts.append(count)
                digests.append(hashlib.sha256(line.encode()).hexdigest() if line else "")
                if len(sums) < len(tool.number):
                    sums = np.concatenate([sums, np.zeros(2 * len(tool.number) - len(sums), np.int64)])
                pair, times = np.unique(pairs, return_counts=True)
                sums[pair] += times
                packed.append(pack(pair, times))
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), np.array(counts, np.int64).reshape(-1, 4).T, strict=True))
            arrays = {c: pa.array(v) for c, v in columns.items()} | {"block": pa.array(np.full(len(texts), block)), "doc_id": batch.column("doc_id"), "groups_sha256": pa.array(digests, pa.string()), "links": pa.array(packed, pa.binary())}
            yield _rows(arrays, len(texts))
        if size:
            yield close()

    return run


def aligned_blocks(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Documents (block, doc_id, counts, digest, packed links) and pairs (block, pair, a, b, n), written once."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    both = staged(rows.mapInArrow(_blocks(model_bytes(path_a, TOKENIZER), model_bytes(path_b, MODEL), block_bytes), _ROWS), "aligned")
    return both.where("pair IS NULL").select("block", *[c.split()[0] for c in _DOCUMENT.split(", ")]), both.where("pair IS NOT NULL").select("block", "pair", "a", "b", "n")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, total, best) for every linked id pair: links in the corpus, and whether no other a has more with b."""
    counts = staged(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    return counts.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def _look_up(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    pair = pairs.column("pair").to_numpy()
    total, best = np.zeros(pair.max(initial=-1) + 1, np.int64), np.zeros(pair.max(initial=-1) + 1, np.int64)
    total[pair], best[pair] = pairs.column("total").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for packed in documents.column("links").to_pylist():
        number, times = unpack(packed)
        n_best.append(int(best[number] @ times))
        count_sum.append(int(total[number] @ times))
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return out.append_column("groups_sha256", documents.column("groups_sha256"))


def alignments(df: DataFrame, **settings) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    documents, pairs = aligned_blocks(df, **settings)
    known = pairs.join(pair_counts(pairs), ["a", "b"]).select(F.col("block").alias("home"), "pair", "total", "best")
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return documents.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(_look_up, kind)
