"""Byte-level BPE with boundaries found by array scans, and decoding with offsets.

The pattern that cuts a text before merging is run as a small automaton over classes
of code points. Every class is a function from states to states; functions compose
associatively, and all compositions of them are few, so each has a number and a table
gives the number of any two after each other. A scan over the numbers (blocks side by
side, then the blocks' totals by the same scan) gives the state before every character
and with it the places where a slice begins. No pattern is matched.

What a class needs from the right is put into it first: whether white space is the last
before something else, and whether an apostrophe opens one of the short endings.

Slices that are new are merged together: in each round every slice merges its pair of
lowest rank, leftmost first, until none has any; a slice that is a token by itself is
taken as it is. Results are kept in a cache of bounded size; slices of over ``SHORT``
bytes are merged by a heap and not kept. Very long texts go through in blocks that end
at a sure boundary, so memory is bounded by the longest slice.

Decoding joins the bytes of the ids. ``ends`` holds where each token ends in the bytes of
the text, so any span of bytes is decoded from the tokens it touches alone.

Null and empty texts have no tokens and decode to no bytes. Repeated rows give repeated
results, an empty table an empty one; other columns, clashing names included, are not
looked at. Letters, numbers and white space are those of this Python's Unicode tables;
code points that are newer may be cut differently than by the tokenizer's library.
"""

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.prefixes import Memo
from fleetspan.llm.token_counts import model_bytes
from fleetspan.llm.words import BASE, pieces

RANKS = "byte_bpe_multi_50k.tiktoken"
SHORT = 48
BLOCK = 1 << 20
"""Characters of a long text that are scanned at once."""

_CUT, LETTER, NUMBER, SPACE, LAST_BLANK, LAST_SPACE, OTHER, SHORT_ENDING, LONG_ENDING = range(9)
"""Classes: between texts; letters; numbers; white space before more of it or the end; a blank, and other
white space, before something else; what is left; an apostrophe before s, t, m, d, and before re, ve, ll."""
_FREE, _JOINED, _LETTERS, _NUMBERS, _OTHERS, _SPACES, _ONE_MORE, _TWO_MORE = range(8)
"""States: at a boundary; after the blank of a slice; in a run; inside an ending with so many letters to come."""
_GOES_ON = {
    LETTER: {_JOINED: _LETTERS, _LETTERS: _LETTERS, _ONE_MORE: _FREE, _TWO_MORE: _ONE_MORE},
    NUMBER: {_JOINED: _NUMBERS, _NUMBERS: _NUMBERS},
    SPACE: {_SPACES: _SPACES},
    OTHER: {_JOINED: _OTHERS, _OTHERS: _OTHERS},
    SHORT_ENDING: {_JOINED: _OTHERS, _OTHERS: _OTHERS},
    LONG_ENDING: {_JOINED: _OTHERS, _OTHERS: _OTHERS},
}
"""The state after a character that stays in the slice."""
_BEGINS = {_CUT: _FREE, LETTER: _LETTERS, NUMBER: _NUMBERS, SPACE: _SPACES, LAST_BLANK: _JOINED, LAST_SPACE: _FREE, OTHER: _OTHERS, SHORT_ENDING: _ONE_MORE, LONG_ENDING: _TWO_MORE}
"""The state after one that begins a slice."""
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_NEVER = np.iinfo(np.int32).max


@lru_cache(1)
def classes_of_code_points() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE] = SPACE
    return table


class _Functions:
    """All compositions of the classes' functions: numbers, what each maps to, and two after each other."""

    def __init__(self):
        of_class = [tuple(_GOES_ON.get(c, {}).get(s, _BEGINS[c]) for s in range(8)) for c in range(9)]
        known = {tuple(range(8)): 0}
        order = list(known)
        for f in order:  # grows while it is read
            for g in of_class:
                if (h := tuple(g[s] for s in f)) not in known:
                    known[h] = len(order)
                    order.append(h)
        self.maps = np.array(order, np.uint8)
        self.n = len(order)
        self.after = np.array([[known[tuple(g[s] for s in f)] for g in order] for f in order], np.uint16).ravel()
        self.of_class = np.array([known[f] for f in of_class], np.uint16)
        self.begins = np.array([[s not in _GOES_ON.get(c, {}) for s in range(8)] for c in range(9)]).ravel()

    def scan(self, numbers: np.ndarray) -> np.ndarray:
        """Number of the composition of all functions up to each place."""
        n = len(numbers)
        width = max(2, int(n**0.5) // 4)
        if n <= 32:
            out = numbers.copy()
            for i in range(1, n):
                out[i] = self.after[int(out[i - 1]) * self.n + int(out[i])]
            return out
        rows = -(-n // width)
        grid = np.zeros(rows * width, np.uint16)  # 0 changes nothing
        grid[:n] = numbers
        grid = np.ascontiguousarray(grid.reshape(rows, width).T)
        for i in range(1, width):
            grid[i] = self.after[grid[i - 1].astype(np.int32) * self.n + grid[i]]
        before = np.zeros(rows, np.uint16)
        before[1:] = self.scan(grid[-1])[:-1]
        return self.after[(before.astype(np.int32) * self.n)[None, :] + grid].T.ravel()[:n]


@lru_cache(1)
def _functions() -> _Functions:
    return _Functions()


def slice_starts(codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where slices begin in an array of code points; ``cuts``: places between texts, which are in the result too."""
    table = _functions()
    kind = np.concatenate([classes_of_code_points()[codes], np.zeros(1, np.uint8)])
    kind[cuts] = _CUT
    space = np.flatnonzero(kind == SPACE)
    last = space[(kind[space + 1] != SPACE) & (kind[space + 1] != _CUT)]
    kind[last] = np.where(codes[last] == 0x20, LAST_BLANK, LAST_SPACE)
    marks = np.flatnonzero(codes == 0x27)
    marks = marks[kind[marks] == OTHER]
    if len(marks):
        open_ = np.concatenate([np.where(kind[:-1] == _CUT, 0, codes), np.zeros(2, codes.dtype)])
        first, second = open_[marks + 1], open_[marks + 2]
        kind[marks[np.isin(first, [ord(c) for c in "stmd"])]] = SHORT_ENDING
        long = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        kind[marks[long]] = LONG_ENDING
    kind = kind[:-1]
    state = np.zeros(len(kind), np.uint8)
    state[1:] = table.maps[table.scan(table.of_class[kind])[:-1], _FREE] if len(kind) else 0
    return np.flatnonzero(table.begins[kind.astype(np.int32) * 8 + state])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def slices_of(text: str, block: int = BLOCK) -> Iterator[str]:
    """The slices of one text of any length, a block at a time."""
    at, size = 0, block
    while at < len(text):
        part = text[at : at + size]
        whole = at + len(part) == len(text)
        starts = slice_starts(_codes(part), np.zeros(0, int)).tolist()
        if not whole:  # the last few may turn out otherwise with what follows
            starts = [s for s in starts if s <= len(part) - 4]
            if len(starts) < 2:
                size *= 2
                continue
        ends = starts[1:] + [len(part)] * whole
        yield from (part[a:b] for a, b in zip(starts, ends, strict=False))
        at, size = at + ends[-1], block


class _Pairs:
    """Rank of every mergeable pair of ranks, by hash; two places for each pair."""

    BITS = 21

    def __init__(self, ranks: dict[bytes, int]):
        found = [(a << 32 | b, n) for t, n in ranks.items() for i in range(1, len(t)) if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
        keys, values = np.array([k for k, _ in found], np.uint64), np.array([v for _, v in found], np.int32)
        self.key, self.value = np.full((2, 1 << self.BITS), (1 << 64) - 1, np.uint64), np.full((2, 1 << self.BITS), _NEVER, np.int32)
        self.rest: dict[int, int] = {}
        for level in (0, 1):
            slot = self._slot(keys, level)
            self.key[level, slot], self.value[level, slot] = keys, values
            lost = self.key[level, slot] != keys
            keys, values = keys[lost], values[lost]
        self.rest = dict(zip(keys.tolist(), values.tolist(), strict=True))
        self._odd = np.array(sorted(self.rest), np.uint64)

    def _slot(self, keys: np.ndarray, level: int) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29 + level))) * (BASE if level == 0 else np.uint64(0xC2B2AE3D27D4EB4F))
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), _NEVER, np.int32)
        for level in (0, 1):
            slot = self._slot(keys, level)
            hit = self.key[level, slot] == keys
            out[hit] = self.value[level, slot[hit]]
        for at in np.flatnonzero(np.isin(keys, self._odd)) if len(self._odd) else ():
            out[at] = self.rest[int(keys[at])]
        return out


class Coder:
    """Encoder and decoder of one rank file."""

    def __init__(self, source: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source.splitlines())}
        self.bytes = {n: t for t, n in self.ranks.items()}
        self._single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._pairs = _Pairs(self.ranks)
        self.slices = Memo(self._slice, longest=SHORT)

    def _result(self, ids: list[int]) -> tuple[int, str, bytes, list[int]]:
        """Number of ids, the ids as text, the bytes they decode to, and the ids."""
        return len(ids), ",".join(map(str, ids)), b"".join(map(self.bytes.__getitem__, ids)), ids

    def _slice(self, piece: str) -> tuple[int, str, bytes, list[int]]:
        return self._result(self.merged(piece.encode()))

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one slice of any length: a heap of pairs by rank and place."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        part = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = [(r, i, 2) for i in range(len(part) - 1) if (r := self.ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not part[i] or j >= len(part) or len(part[i]) + len(part[j]) != size:
                continue  # one of the two has been merged since
            part[i], part[j] = part[i] + part[j], b""
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < len(part) and (r := self.ranks.get(both := part[a] + part[after[a]])) is not None:
                    heapq.heappush(heap, (r, a, len(both)))
        return [self.ranks[p] for p in part if p]

    def _merge_all(self, words: list[str]) -> Iterable[tuple[int, str, bytes, list[int]]]:
        """The same for many short slices, a merge in each of them a round."""
        raw = [w.encode() for w in words]
        found: list[list[int]] = [[n] if (n := self.ranks.get(r)) is not None else [] for r in raw]
        todo = np.array([i for i, ids in enumerate(found) if not ids], int)
        lengths = np.array([len(raw[i]) for i in todo], int)
        token = self._single[np.frombuffer(b"".join([raw[i] for i in todo]), np.uint8)]
        word = np.repeat(np.arange(len(todo)), lengths)
        rank = np.full(len(token), _NEVER, np.int32)

        def look(at: np.ndarray) -> None:
            pair = (at >= 0) & (at + 1 < len(token))
            at = at[pair]
            same = word[at] == word[at + 1]
            rank[at[~same]] = _NEVER
            at = at[same]
            rank[at] = self._pairs.of(token[at], token[at + 1])

        look(np.arange(len(token)))
        while len(token):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(word)))
            over = best == _NEVER
            if over.any():
                for a, n in zip(first[over].tolist(), size[over].tolist(), strict=True):
                    found[todo[word[a]]] = token[a : a + n].tolist()
                live = np.repeat(~over, size)
                token, word, rank = token[live], word[live], rank[live]
                best, size = best[~over], size[~over]
                if not len(token):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            hit = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])]  # the leftmost of each word
            token[hit] = best
            keep = np.ones(len(token), bool)
            keep[hit + 1] = False
            token, word, rank = token[keep], word[keep], rank[keep]
            hit = hit - np.arange(len(hit))  # one place went before each later word
            rank[hit] = _NEVER
            look(hit)
            look(hit - 1)
        return map(self._result, found)

    def parts_of(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes, list[int]]]]:
        """For each text the results of its slices in order."""
        short = [t if len(t) <= BLOCK else "" for t in texts]
        joined = "\n".join(short) + "\n"
        cuts = np.cumsum([len(t) + 1 for t in short]) - 1
        starts = slice_starts(_codes(joined), cuts)
        bounds = np.searchsorted(starts, cuts)
        places = starts.tolist()
        found = [joined[a:b] for a, b in zip(places, places[1:], strict=False)]
        self.slices.fill(set(found), self._merge_all)
        first = 0
        for text, last in zip(texts, bounds.tolist(), strict=True):
            yield [self.slices[s] for s in (found[first:last] if len(text) <= BLOCK else slices_of(text))]
            first = last + 1

    def encode(self, text: str) -> list[int]:
        return [i for part in next(self.parts_of([text])) for i in part[3]]

    def ends(self, ids: list[int]) -> np.ndarray:
        """Where each token ends in the bytes of the text."""
        return np.cumsum([len(self.bytes[i]) for i in ids], dtype=np.int64)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def span(self, ids: list[int], ends: np.ndarray, start: int, stop: int) -> bytes:
        """Bytes start to stop of the text, from the tokens that they touch."""
        first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        base = int(ends[first - 1]) if first else 0
        return self.decode(ids[first:last])[start - base : max(stop - base, 0)]


@lru_cache(2)
def coder(source: bytes) -> Coder:
    return Coder(source)


def _in(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and ends (of each token, in bytes) of every row."""
    source = model_bytes(path, RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(source)
        for batch in pieces(batches):
            ids = [[i for part in parts for i in part[3]] for parts in tool.parts_of([t or "" for t in batch.column("text").to_pylist()])]
            ends = pa.array([tool.ends(row) for row in ids], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), ends], names=["doc_id", "n_tokens", "ids", "ends"])

    return _in(df, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, ends array<long>")


def decode_documents(df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """doc_id, the decoded bytes and their text of every row of ids; null ids are none."""
    source = model_bytes(path, RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(source)
        for batch in batches:
            raw = [tool.decode(row or []) for row in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())], names=["doc_id", "decoded", "text"])

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded binary, text string")


def encoding_digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by commas) and of the decoded bytes."""
    source = model_bytes(path, RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(source)
        for batch in pieces(batches):
            count, ids, decoded = [], [], []
            for parts in tool.parts_of([t or "" for t in batch.column("text").to_pylist()]):
                count.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.record_batch(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _in(df, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
