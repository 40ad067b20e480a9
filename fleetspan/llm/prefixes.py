"""Byte-pair tokens of every prefix of a word, by dynamic programming.

A sequence of tokens is what the merge list makes of a string exactly if the
first token alone and each two neighbours are (merging the string of just those
two gives them back). So the last token of a prefix is the one vocabulary string
at its end that may follow the last token of the prefix before it, and there is
only one such. Each prefix costs a few dictionary look-ups, whatever comes after.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np

from fleetspan.llm.words import BASE, mixed, powers

KEPT_PAIRS = 400_000
BATCH_SYMBOLS = 48
"""Longer words go through the table one by one."""
_SLOT_BITS, _PAIR_BITS = 18, 21


class Prefixes:
    """The dynamic program for one merge list.

    vocabulary: the strings that can be tokens, one character a symbol.
    rank: of merging two neighbours (lower first, then from the left), None if they don't merge.
    """

    def __init__(self, vocabulary: Iterable[str], rank: Callable[[str, str], float | None]):
        self.vocabulary = frozenset(vocabulary)
        self.rank = rank
        self.longest = max(map(len, self.vocabulary), default=1)
        self._follows: dict[str, dict[str, bool]] = {}
        self._alone: dict[str, bool] = {}
        self._pairs = 0

    def merged(self, symbols: Iterable[str]) -> list[str]:
        """Merge the best pair, leftmost first, until none is left."""
        parts = list(symbols)
        while len(parts) > 1:
            ranks = [(r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None]
            if not ranks:
                break
            i = min(ranks)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _first(self, token: str) -> bool:
        if (ok := self._alone.get(token)) is None:
            ok = self._alone[token] = self.merged(token) == [token]
        return ok

    def _row(self, token: str) -> dict[str, bool]:
        if (row := self._follows.get(token)) is None:
            if self._pairs > KEPT_PAIRS:
                self._follows.clear()
                self._pairs = 0
            row = self._follows[token] = {}
        return row

    def steps(self, symbols: str) -> Iterator[tuple[int, bool]]:
        """Length of the last token of every prefix, and whether the vocabulary has it."""
        words, longest = self.vocabulary, self.longest
        rows: list[dict[str, bool] | None] = [None]  # what may follow the last token of each prefix
        last: list[str] = [""]
        base = 0
        for i in range(1, len(symbols) + 1):
            for size in range(min(i, longest), 0, -1):
                token = symbols[i - size : i]
                if token not in words:
                    continue
                before = i - size - base
                row = rows[before]
                if row is None:  # the start, or a symbol that nothing merges with
                    ok = self._first(token)
                elif (ok := row.get(token)) is None:
                    ok = row[token] = self.merged(last[before] + token) == [last[before], token]
                    self._pairs += 1
                if ok:
                    rows.append(self._row(token))
                    last.append(token)
                    yield size, True
                    break
            else:
                rows.append(None)
                last.append("")
                yield 1, False
            if len(rows) > 4 * longest:  # only the last few prefixes are looked at again
                drop = len(rows) - longest - 1
                del rows[:drop], last[:drop]
                base += drop

    def tokens(self, symbols: str) -> list[str]:
        """Tokens of a short string, from the whole table."""
        sizes = [size for size, _ in self.steps(symbols)]
        at, found = len(symbols), []
        while at:
            found.append(symbols[at - sizes[at - 1] : at])
            at -= sizes[at - 1]
        return found[::-1]


class _Strings:
    """Ids of strings by 64-bit hash, each in one of two places of a table."""

    def __init__(self, hashes: np.ndarray):
        self.hash = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.id = np.full(1 << _SLOT_BITS, -1, np.int32)
        for n, h in enumerate(hashes):
            at = -1
            for _ in range(500):
                places = [int(p) for p in self._places(h)]
                at = next((p for p in places if self.id[p] < 0), places[places[0] == at])  # else drive out another
                (h, n), (self.hash[at], self.id[at]) = (self.hash[at], self.id[at]), (h, n)
                if n < 0:
                    break
            else:
                raise ValueError("too many strings for the table")

    @staticmethod
    def _places(h):
        return h >> np.uint64(64 - _SLOT_BITS), (h >> np.uint64(8)) & np.uint64((1 << _SLOT_BITS) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The id of each hash, -1 for strings that aren't in the table."""
        one, two = self._places(h)
        return np.where(self.hash[one] == h, self.id[one], np.where(self.hash[two] == h, self.id[two], -1))


class Batch:
    """The same dynamic program for many short words at once, one prefix length after another."""

    def __init__(self, prefixes: Prefixes):
        self.prefixes = prefixes
        self.strings = sorted(prefixes.vocabulary)
        symbols, bounds = self._symbols(self.strings)
        self.table = _Strings(self._sums(symbols)(bounds[:-1], bounds[1:]))
        self.sizes = sorted({len(t) for t in self.strings}, reverse=True)
        self._pair = np.full(1 << _PAIR_BITS, np.iinfo(np.int64).max)
        self._follows = np.zeros(1 << _PAIR_BITS, bool)

    @staticmethod
    def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        return codes, np.cumsum([0, *map(len, words)])

    @staticmethod
    def _sums(codes: np.ndarray):
        """Hashes of runs of symbols, by prefix sums."""
        up, down = powers(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed((codes.astype(np.uint64) + np.uint64(1)) * BASE) * up[: len(codes)], out=sums[1:])
        return lambda a, b: mixed((sums[b] - sums[a]) * down[a])

    def _may_follow(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = ((before.astype(np.int64) + 1) << 20) | token
        slot = (key.view(np.uint64) * BASE) >> np.uint64(64 - _PAIR_BITS)
        known, ok = self._pair[slot] == key, self._follows[slot]
        if not known.all():
            new, at = np.unique(key[~known], return_inverse=True)
            found = np.fromiter((self._check(int(k) // (1 << 20) - 1, int(k) % (1 << 20)) for k in new), bool, len(new))
            ok[~known] = found[at]
            slot = (new.view(np.uint64) * BASE) >> np.uint64(64 - _PAIR_BITS)
            self._pair[slot], self._follows[slot] = new, found
            again = self._pair[slot] != new  # two new pairs in one place: the place may hold either's answer
            self._pair[slot[again]] = np.iinfo(np.int64).max
        return ok

    def _check(self, before: int, token: int) -> bool:
        token = self.strings[token]
        if before < 0:
            return self.prefixes.merged(token) == [token]
        return self.prefixes.merged(self.strings[before] + token) == [self.strings[before], token]

    def run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Last token (-1: a symbol outside the vocabulary) and its size for the prefixes of all words, and where each word's begin."""
        codes, bounds = self._symbols(words)
        hashes = self._sums(codes)
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        start = bounds[:-1] + np.arange(len(words))  # each word has a place for its empty prefix
        token = np.full(len(codes) + len(words), -1, np.int32)
        size = np.ones(len(codes) + len(words), np.int32)
        longest = int(lengths.max(initial=0))
        active = np.searchsorted(-lengths[order], -np.arange(longest + 1), side="right")
        for i in range(1, longest + 1):
            open_ = order[: active[i]]
            for n in self.sizes:
                if n > i:
                    continue
                if not len(open_):
                    break
                begin = bounds[open_] + (i - n)
                found = self.table.find(hashes(begin, begin + n))
                hit = np.flatnonzero(found >= 0)
                if not len(hit):
                    continue
                at, found = open_[hit], found[hit]
                ok = self._may_follow(token[start[at] + (i - n)], found)
                done = start[at[ok]] + i
                token[done], size[done] = found[ok], n
                left = np.ones(len(open_), bool)
                left[hit[ok]] = False
                open_ = open_[left]
        return token, size, start


class Memo(dict):
    """Results by word, forgotten all at once when too many; very long words aren't kept."""

    def __init__(self, make: Callable, limit: int = 300_000, longest: int = BATCH_SYMBOLS):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def fill(self, words: Iterable[str], make_all: Callable[[list[str]], Iterable]) -> None:
        """Work out the short words that are missing, all at once."""
        short = [w for w in words if len(w) <= self.longest]
        new = [w for w in short if w not in self]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = short
        self.update(zip(new, make_all(new), strict=True) if new else ())

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value
