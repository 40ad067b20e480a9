"""Token counts at every prefix of a text, by dynamic programming.

The pieces of the model begin with the mark of a blank or hold none, so a text
falls into words (a run of blanks and what follows it) that never merge with
each other. Inside a word the table of :mod:`prefixes` has the last token of
every prefix, hence its token count: the count of the prefix before that token and one
more. These counts are stored for every prefix of every different word. The count of a
text, of any cut of it, or the longest cut within a budget is read off them; nothing is
encoded again. Tables of short words are kept in the worker in a cache of fixed size.

Null and empty texts have no tokens. Repeated rows give repeated results. Texts
of any length are counted whole, with no truncation, padding or added tokens.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.prefixes import Batch, Memo, Prefixes
from fleetspan.llm.words import pieces

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
"""What the model writes for a blank; in a text it means a blank too."""
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*")


class Counter:
    """Counts of one piece model (a BPE model with byte fallback and no normalization)."""

    def __init__(self, model: bytes):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        usable = (i for i in range(pieces.get_piece_size()) if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i)))
        order = {pieces.id_to_piece(i): -pieces.get_score(i) for i in usable}
        if any(BLANK in p.lstrip(BLANK) for p in order):
            raise ValueError("a piece of this model spans words")
        self.table = Prefixes(order, lambda a, b: order.get(a + b))
        self.batch = Batch(self.table)
        self.words = Memo(lambda word: self.prefixes(BLANK + word))

    def prefixes(self, symbols: str) -> list[int]:
        """Token counts of all prefixes that aren't empty; a symbol outside the vocabulary counts its bytes."""
        counts = [0]
        for i, (size, known) in enumerate(self.table.steps(symbols), 1):
            counts.append(counts[i - size] + (1 if known else len(symbols[i - 1].encode())))
        return counts[1:]

    def _tables(self, words: list[str]) -> list[list[int]]:
        """Token counts of all prefixes of all words, one prefix length after another."""
        words = [BLANK + w for w in words]
        token, size, start = self.batch.run(words)
        lengths = np.array([len(w) for w in words])
        step = np.ones(len(token), np.int32)
        odd = np.ones(len(token), bool)
        odd[start] = False
        odd = np.flatnonzero(odd & (token < 0))
        word = np.searchsorted(start, odd, side="right") - 1
        step[odd] = [len(words[w][p - 1].encode()) for w, p in zip(word, odd - start[word], strict=True)]
        counts = np.zeros(len(token), np.int32)
        order = np.argsort(-lengths, kind="stable")
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0) + 1), side="right")
        for i in range(1, len(active)):
            at = start[order[: active[i]]] + i
            counts[at] = counts[at - size[at]] + step[at]
        flat = counts.tolist()
        return [flat[a + 1 : a + 1 + n] for a, n in zip(start.tolist(), lengths.tolist(), strict=True)]

    def _split(self, text: str) -> list[str]:
        """The words of a text without the blank before each; further blanks of a run stay in their word."""
        words = text.replace(BLANK, " ").split(" ")
        if "" in words:
            words = [word[1:] for word in _WORD.findall(BLANK + BLANK.join(words))]
        return words

    def read(self, texts: list[str], limit: int) -> list[tuple[int, int]]:
        """For each text its tokens, and the characters of its longest prefix with at most ``limit`` tokens."""
        split = [self._split(t) if t else [] for t in texts]
        self.words.fill({w for words in split for w in words}, self._tables)
        return [self._read(words, limit) for words in split]

    def _read(self, words: list[str], limit: int) -> tuple[int, int]:
        tables = list(map(self.words.__getitem__, words))
        total = sum([t[-1] for t in tables])
        if total <= limit:
            return total, max(sum(map(len, tables)) - 1, 0)
        # Every word has a token at least, so the last one that begins below the limit holds the cut.
        before = np.concatenate([[0], np.cumsum([t[-1] for t in tables])])
        last = int(np.searchsorted(before[:-1], limit - 1, side="right")) - 1
        if last < 0:
            return total, 0
        cut = int(np.flatnonzero(before[last] + np.array(tables[last]) <= limit)[-1])
        return total, sum(map(len, tables[:last])) + cut

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return self.read([text], 1)[0][0]

    def every_prefix(self, text: str) -> np.ndarray:
        """Count of text[:p] for p = 0 ... len(text)."""
        counts, done = [0], 0
        for word in _WORD.findall(BLANK + text.replace(" ", BLANK)) if text else ():
            table = self.prefixes(word)
            counts.extend(done + n for n in table)
            done += table[-1]
        return np.array(counts[:1] + counts[2:], np.int64)  # the blank put before a text is no cut of it

    def longest_within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        return int(np.flatnonzero(self.every_prefix(text) <= budget)[-1])


@lru_cache(2)
def _counter(model: bytes) -> Counter:
    return Counter(model)


def model_bytes(path: str | None = None, name: str = MODEL) -> bytes:
    """A vocabulary file, read on the driver and sent to the tasks (its size doesn't depend on the data)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as file:
        return file.read()


def _counts(model: bytes, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens, fit = zip(*counter.read(texts, limit), strict=True)
            over = [n > limit for n in tokens]
            size = [len(t.encode()) for t in texts]
            arrays = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_()), pa.array(fit, pa.int64())]
            yield pa.record_batch(arrays, names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return run


def _in(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def token_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = 4096, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars (of the longest prefix within the limit) of every row."""
    kind = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return _in(df, doc_id, text).mapInArrow(_counts(model_bytes(path), limit), kind)


def prefix_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = 4096, path: str | None = None) -> DataFrame:
    """doc_id, counts (of every prefix, the empty one first) and fit_chars (the longest prefix within the budget)."""
    model = model_bytes(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts = counter.every_prefix(body or "")
                fit = int(np.flatnonzero(counts <= budget)[-1])
                arrays = [pa.array([doc], pa.int64()), pa.array([counts], pa.list_(pa.int64())), pa.array([fit], pa.int64())]
                yield pa.record_batch(arrays, names=["doc_id", "counts", "fit_chars"])

    return _in(df, doc_id, text).mapInArrow(run, "doc_id long, counts array<long>, fit_chars long")
