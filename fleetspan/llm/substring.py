"""Repeated word runs, found in a compacted De Bruijn graph of word k-mers.

A window is ``window`` consecutive words of one document; every word that a
window covers whose words also start anywhere else is removed.

Edges of the graph are k-mers of words. Of the k-mers inside a window the one
with the smallest hash (the first, in a tie) is the window's edge, so equal
windows have equal edges at equal places. Neighbouring windows with the same
edge form the path through it; its key is the hash of all their words.

1. Edges that occur once are dropped: none of their windows repeats.
2. An edge whose occurrences all lie on one path does not branch. The path is
   compacted: all its windows repeat, without looking at any of them.
3. At branching edges, paths that occur more than once are compacted likewise.
   One occurrence of each distinct path goes back to its source coordinates,
   and its windows are compared by 128-bit hashes.

Occurrences of one path inside one document travel as one row, so a line that
a document repeats thousands of times costs one. Counts are combined before they
are shuffled and joined back to these rows, so a passage that a third of all
documents share is spread over tasks. Hashes
stand for words (64 bits for edges and paths, 128 for windows).

Nulls and empty texts have no words. Repeated rows are documents of their own:
each repeats the other. Texts of any length are taken whole. An empty table
gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.words import BASE, SECOND, SMALL_PIECE, fresh, mixed, pieces, row_key, run_hashes, signed, words_of
from fleetspan.plans.shared import staged

WINDOW = 35
EDGE = 8
_SCAN = "edge long, path long, at long, others array<long>, row long, doc_id long, n_words long, sha256 string"
_KEPT = "row long, n_removed long, sha256 string, text string"


def _first_smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of hashes[i:i + width], for every i where it fits."""
    n = len(hashes) - width + 1
    at, size = np.arange(len(hashes), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        near, far = at[: len(at) - step], at[step:]
        at, size = np.where(hashes[far] < hashes[near], far, near), size + step
    return at[:n]


def _paths(words, window: int, k: int):
    """(edge hash, path hash, first window, windows) of every edge occurrence."""
    value = words.hashes()
    windows = words.run_starts(window)
    if not len(windows):
        return None
    n = len(value) - k + 1
    begin = np.arange(n)
    kmers = run_hashes(value, begin, begin + k)
    edge = _first_smallest(kmers, window - k + 1)[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (edge[1:] != edge[:-1]) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(windows)))
    first, at = windows[head], edge[head]
    path = run_hashes(value, first, first + count + window - 1, SECOND)
    path = mixed(path ^ ((at - first).astype(np.uint64) * BASE))
    return kmers[at], path, first, count


def _by_document(doc: np.ndarray, edge: np.ndarray, path: np.ndarray, at: np.ndarray):
    """One of each (document, edge, path): its index, its first place, and its other places (null if none)."""
    order = np.lexsort((path, edge, doc))
    doc, edge, path, at = doc[order], edge[order], path[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (edge[1:] != edge[:-1]) | (path[1:] != path[:-1])
    head = np.flatnonzero(new)
    more = np.diff(np.append(head, len(new))) - 1
    bounds = pa.array(np.append(0, np.cumsum(more)).astype(np.int32))
    others = pa.ListArray.from_arrays(bounds, pa.array(at[~new]), mask=pa.array(more == 0))
    return order[head], pa.array(at[head]), others


def _scan(window: int, k: int):
    places = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"sha256": pa.string(), "others": places}
        schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in ("edge", "path", "at", "others", "row", "doc_id", "n_words", "sha256")])
        for piece in pieces(batches, most=SMALL_PIECE):
            words = words_of(piece.column("text"))
            docs = piece.num_rows
            none = pa.nulls(docs, pa.int64())
            sha = [hashlib.sha256(b" ".join(words.bytes_of(d).split())).hexdigest() for d in range(docs)]
            n_words = pa.array(np.diff(words.first))
            lists = pa.nulls(docs, places)
            yield pa.record_batch([none, none, none, lists, piece.column("row"), piece.column("doc_id"), n_words, pa.array(sha, pa.string())], schema=schema)
            found = _paths(words, window, k)
            if found is None:
                continue
            edge, path, first, count = found
            doc = words.doc[first]
            one, at, others = _by_document(doc, edge, path, ((first - words.first[doc]) << 24) | count)
            none = pa.nulls(len(one), pa.int64())
            row = piece.column("row").take(pa.array(doc[one]))
            yield pa.record_batch([signed(edge[one]), signed(path[one]), at, others, row, none, none, none.cast(pa.string())], schema=schema)

    return run


def _windows(window: int):
    """Add the hashes of the windows to look at: one list of (at, h1, h2) a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("at", pa.int64()), ("single", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int64())]))
        for piece in pieces(batches, most=SMALL_PIECE):
            words = words_of(piece.column("text"))
            value = words.hashes()
            second = mixed(value ^ SECOND)
            paths = piece.column("paths").fill_null(pa.scalar([], piece.column("paths").type))
            sizes = paths.value_lengths().to_numpy()
            flat = paths.flatten()
            at, single = flat.field("at").to_numpy(zero_copy_only=False), flat.field("single").to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            first, count = at >> 24, at & 0xFFFFFF
            total = int(count.sum())
            step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            inside = np.repeat(first, count) + step
            doc = np.repeat(doc, count)
            begin = inside + words.first[doc]
            h1 = run_hashes(value, begin, begin + window, BASE)
            h2 = run_hashes(second, begin, begin + window, SECOND)
            items = pa.StructArray.from_arrays([pa.array(inside), pa.array(np.repeat(single, count)), signed(h1), signed(h2)], fields=list(kind.value_type))
            per_doc = np.bincount(doc, minlength=piece.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_doc)).astype(np.int32)), items, type=kind)
            yield pa.record_batch([piece.column("row"), piece.column("text"), piece.column("spans"), lists], names=["row", "text", "spans", "windows"])

    return run


def _kept(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, most=SMALL_PIECE):
            rows, removed, sha, kept = piece.column("row"), [], [], []
            for text, spans, more in zip(*(piece.column(c).to_pylist() for c in ("text", "spans", "found")), strict=True):
                words = text.encode().split()
                gone = np.zeros(len(words) + 1, np.int32)
                for at in spans or ():
                    first, count = at >> 24, at & 0xFFFFFF
                    gone[first] += 1
                    gone[first + count + window - 1] -= 1
                for first in more or ():
                    gone[first] += 1
                    gone[first + window] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                left = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
                removed.append(int(len(words) - keep.sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode() if with_text else None)
            yield pa.record_batch([rows, pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["row", "n_removed", "sha256", "text"])

    return run


def _removals(docs: DataFrame, window: int, k: int, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """All documents with their whole digests, and what is left of those that lose words."""
    scan = staged(docs.mapInArrow(_scan(window, k), _SCAN), "edges")
    edges = scan.where(F.col("path").isNotNull()).select("edge", "path", "at", "others", "row")
    occurrences = F.sum(1 + F.coalesce(F.array_size("others"), F.lit(0))).alias("n")
    known = edges.groupBy("edge").agg(occurrences, F.min("path").alias("low"), F.max("path").alias("high"))
    known = known.where("n > 1").select("edge", (F.col("low") == F.col("high")).alias("straight"))
    known = staged(known, "known")  # a table of its own, so the join can split an edge that many documents share
    again = staged(edges.join(known, "edge"), "repeated")
    forks = again.where(~F.col("straight"))
    paths = forks.groupBy("edge", "path").agg(occurrences, F.min(F.struct("row", "at")).alias("one"))
    paths = staged(paths, "paths")
    copied = forks.join(paths.where("n > 1").select("edge", "path"), ["edge", "path"])
    whole = again.where("straight").select("row", "at", "others").union(copied.select("row", "at", "others")).distinct()
    whole = whole.select("row", F.concat(F.array("at"), F.coalesce("others", F.array().cast("array<long>"))).alias("places"))
    look = paths.select("one.row", F.struct(F.col("one.at").alias("at"), (F.col("n") == 1).alias("single")).alias("path_at"))
    marks = whole.select("row", "places", F.lit(None).cast(look.schema["path_at"].dataType).alias("path_at")).union(look.select("row", F.lit(None).cast("array<long>"), "path_at"))
    marks = marks.groupBy("row").agg(F.flatten(F.collect_list("places")).alias("spans"), F.collect_list("path_at").alias("paths"))
    found = docs.select("row", "text").join(marks, "row")
    kind = "row long, text string, spans array<long>, windows array<struct<at: long, single: boolean, h1: long, h2: long>>"
    found = staged(found.mapInArrow(_windows(window), kind), "windows")
    hits = found.select("row", F.explode("windows").alias("w")).select("row", "w.*").distinct()
    twice = hits.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    more = hits.where("single").join(twice, ["h1", "h2"]).groupBy("row").agg(F.collect_list("at").alias("found"))
    cut = found.select("row", "text", "spans").join(more, "row", "left").where((F.size("spans") > 0) | F.col("found").isNotNull())
    cut = cut.mapInArrow(_kept(window, with_text), _KEPT)
    one = [F.first(c).alias(c) for c in ("n_removed", "sha256", "text")]
    return scan.where(F.col("n_words").isNotNull()).select("row", "doc_id", "n_words", "sha256"), cut.groupBy("row").agg(*one)


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(row_key(doc_id, text).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def substring_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, k: int = EDGE) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by a blank) of every row."""
    whole, cut = _removals(_rows(df, doc_id, text), window, k, with_text=False)
    cut = cut.select("row", "n_removed", F.col("sha256").alias("cut_sha256"))
    return whole.join(cut, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
    )


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, k: int = EDGE) -> DataFrame:
    """The same rows and columns; texts that lose words hold their other words joined by a blank."""
    key, left = fresh(df, "row_key"), fresh(df, "kept_text")
    _, cut = _removals(_rows(df, doc_id, text), window, k, with_text=True)
    cut = cut.select(F.col("row").alias(key), F.col("text").alias(left))
    joined = df.withColumn(key, row_key(doc_id, text)).join(cut, key, "left")
    return joined.withColumn(text, F.coalesce(left, text)).select(*df.columns)
