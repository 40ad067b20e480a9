"""BPE encoding as a streaming transducer with bounded lookahead, and decoding.

The encoder reads a text front to back. Special strings are cut out, white
space ends a chunk, and a chunk falls into words by the tokenizer's pattern.
Inside a word the table of :mod:`prefixes` gives the last token of each prefix;
any prefix that a later token can begin at is at most the longest token away.
Follow the last tokens back from all of these: where they all pass through one
place, what lies before it can't change any more. The lookahead that the merge list needs
is computed from it (``lookahead``): a token that far back is stable. So a word's symbols
are held until there are more than that, then what is stable is emitted, and memory doesn't
grow with a word. A word that ends earlier is emitted at its end; such words are short, and
many of them go through the table at once. Whole chunks that come again are answered
from a bounded cache.

The decoder is a state machine over ids: it emits each token's string as soon
as it arrives, a blank before it unless it is the first. ``text_stream`` gives
readable text: bytes pass through an incremental UTF-8 decoder and word ends
become blanks.

Null and empty texts have no tokens and decode to an empty text. Texts are
encoded whole. Repeated rows give repeated results.
"""

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.prefixes import BATCH_SYMBOLS, Batch, Memo, Prefixes
from fleetspan.llm.token_counts import model_bytes
from fleetspan.llm.words import pieces

TOKENIZER = "word_bpe_49k.json"
END = 0x10000
"""Added to the code of a word's last symbol; bytes are written as code points below it."""
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACES = re.compile(f"[{_SPACE}]+")
_UNLIKE = re.compile("[\x1c-\x1f]")
"""What Python takes for white space and the tokenizer doesn't."""


def byte_letters() -> list[str]:
    """A printable character for each byte: itself if printable, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Transducer:
    """Encoder and decoder of one tokenizer file: words with ends, lower case, white space dropped."""

    def __init__(self, source: bytes):
        import regex

        spec = json.loads(source)
        suffix = spec["model"]["end_of_word_suffix"]
        own = lambda t: t[: -len(suffix) - 1] + chr(ord(t[-len(suffix) - 1]) + END) if t.endswith(suffix) and len(t) > len(suffix) else t
        vocabulary = spec["model"]["vocab"]
        self.ids = {own(t): i for t, i in vocabulary.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(own(a), own(b)): n for n, (a, b) in enumerate(pairs)}
        self.table = Prefixes(self.ids, lambda a, b: self.rank.get((a, b)))
        self.batch = Batch(self.table)
        self.strings = {i: t for t, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: t for t, i in self.special.items()}
        self._cuts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", _SPACE))
        self._letters, self._suffix = byte_letters(), suffix
        self._empty = False  # whether some chunk had no token
        self.chunks = Memo(self._chunk)

    @cached_property
    def lookahead(self) -> int:
        """Symbols after which a token can't change: the deepest chain of merges times the longest token."""
        depth: dict[str, int] = {}
        for a, b in self.rank:
            depth[a + b] = max(depth.get(a + b, 0), 1 + max(depth.get(a, 0), depth.get(b, 0)))
        return self.table.longest * (1 + max(depth.values(), default=0))

    def word(self, symbols: str) -> Iterator[str]:
        """Tokens of one word, each emitted once it is stable; no more than the lookahead and two tokens are held."""
        longest = self.table.longest
        held = self.lookahead + 2 * longest
        sizes: list[int] = []  # of the last tokens of the prefixes that aren't emitted yet
        base = 0

        def back(at: int) -> list[int]:
            places = [at]
            while at > base:
                at -= sizes[at - base - 1]
                places.append(at)
            return places

        for end, (size, _) in enumerate(self.table.steps(symbols), 1):
            sizes.append(size)
            if end == len(symbols):
                stable = end
            elif len(sizes) < held:
                continue
            else:  # what lies the lookahead back is stable; all prefixes that may go on pass through it
                live = range(end - longest + 1, end + 1)
                stable = max(p for p in set.intersection(*(set(back(at)) for at in live)) if p <= end - self.lookahead)
            places = back(stable)[::-1]
            for a, b in zip(places, places[1:], strict=False):
                yield symbols[a:b]
            del sizes[: stable - base]
            base = stable

    def _symbols(self, word: str) -> str:
        symbols = word if word.isascii() and word.isalnum() else "".join([self._letters[b] for b in word.encode()])
        return symbols[:-1] + chr(ord(symbols[-1]) + END)

    def _part(self, ids: list[int]) -> tuple[int, str, str]:
        self._empty = self._empty or not ids
        return len(ids), " ".join(map(str, ids)), " ".join([self.strings[i] for i in ids])

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """Count, ids and token strings (joined by blanks) of a text without white space."""
        return self._part([self.ids[t] for w in self._pattern.findall(chunk) for t in self.word(self._symbols(w)) if t in self.ids])

    def _chunks(self, chunks: list[str]) -> Iterator[tuple[int, str, str]]:
        """The same for many chunks at once; words shorter than the lookahead, which end before anything is stable, go together."""
        split = [[self._symbols(w) for w in self._pattern.findall(c)] for c in chunks]
        words = list({w for ws in split for w in ws if len(w) <= BATCH_SYMBOLS})
        token, size, start = self.batch.run(words)
        number = [self.ids[t] for t in self.batch.strings]
        token, size, of = token.tolist(), size.tolist(), {}
        for word, first in zip(words, start.tolist(), strict=True):
            at, ids = first + len(word), []
            while at > first:
                if token[at] >= 0:
                    ids.append(number[token[at]])
                at -= size[at]
            of[word] = ids[::-1]
        for found in split:
            yield self._part([i for w in found for i in (of[w] if w in of else [self.ids[t] for t in self.word(w) if t in self.ids])])

    def _split(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # a sigma has one lower case here
        return [c for c in _SPACES.split(text) if c] if _UNLIKE.search(text) else text.split()

    def _pieces(self, text: str) -> list[list[str] | str]:
        """Chunks between special strings, and these."""
        found = self._cuts.split(text) if self._cuts else [text]
        return [p if p in self.special else self._split(p) for p in found]

    def parts_of(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text (count, ids, strings) of the chunks that have tokens."""
        cut = [self._pieces(t) for t in texts]
        self.chunks.fill({c for pieces in cut for p in pieces if not isinstance(p, str) for c in p}, self._chunks)
        for pieces in cut:
            found = []
            for piece in pieces:
                if isinstance(piece, str):
                    found.append((1, str(self.special[piece]), piece))
                else:
                    found += map(self.chunks.__getitem__, piece)
            yield [p for p in found if p[0]] if self._empty else found

    def parts(self, text: str) -> list[tuple[int, str, str]]:
        return next(self.parts_of([text]))

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.parts(text) for i in p[1].split(" ")]

    def stream(self, blocks: Iterable[str]) -> Iterator[int]:
        """Ids of a text that comes in blocks; what is held back is the last chunk."""
        held = ""
        for block in blocks:
            held += block
            cut = max((m.end() for m in _SPACES.finditer(held)), default=0)
            yield from self.encode(held[:cut])
            held = held[cut:]
        yield from self.encode(held)

    def decode(self, ids: Iterable[int]) -> str:
        """As the tokenizer file says: it names no decoder, so token strings are joined by blanks."""
        return "".join(self.decode_stream(ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        first = True
        for i in ids:
            yield ("" if first else " ") + self.strings[i]
            first = False

    def text_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text: bytes of the tokens, a blank for each word end."""
        values = {letter: b for b, letter in enumerate(self._letters)}
        utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            token = self.strings[i]
            ends = token.endswith(self._suffix)
            raw = token.removesuffix(self._suffix) if ends else token
            yield utf8.decode(raw.encode() if token in self.special else bytes(values[c] for c in raw)) + " " * ends
        yield utf8.decode(b"", True)


@lru_cache(2)
def _transducer(source: bytes) -> Transducer:
    return Transducer(source)


def _in(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    source = model_bytes(path, TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _transducer(source)
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [[int(i) for p in parts for i in p[1].split(" ")] for parts in coder.parts_of(texts)]
            arrays = [batch.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.record_batch(arrays, names=["doc_id", "n_tokens", "ids"])

    return _in(df, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def encoding_digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by blanks) and of the decoded text."""
    source = model_bytes(path, TOKENIZER)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _transducer(source)
        for batch in pieces(batches):
            count, ids, decoded = [], [], []
            for parts in coder.parts_of([t or "" for t in batch.column("text").to_pylist()]):
                numbers, id_texts, strings = zip(*parts, strict=True) if parts else ((), (), ())
                count.append(sum(numbers))
                ids.append(sha(" ".join(id_texts)))
                decoded.append(sha(" ".join(strings)))
            arrays = [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.record_batch(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _in(df, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_documents(df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """doc_id, decoded (token strings) and text (readable) of every row of ids; null ids are none."""
    source = model_bytes(path, TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _transducer(source)
        for batch in batches:
            rows = [r or [] for r in batch.column("ids").to_pylist()]
            decoded = pa.array([coder.decode(r) for r in rows], pa.string())
            plain = pa.array(["".join(coder.text_stream(r)) for r in rows], pa.string())
            yield pa.record_batch([batch.column("doc_id"), decoded, plain], names=["doc_id", "decoded", "text"])

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string, text string")
