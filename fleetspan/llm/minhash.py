"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct word shingles (64-bit hashes; fewer words
than a shingle make one shingle, no words an empty set). One permutation
scatters the shingles over 2**32 places; the signature takes the smallest value
of a second permutation, whose argument is shifted by one place for each
coordinate. So two permutations make all coordinates.

Documents with equal sets (128-bit digests) are one class from the start, and a
class is searched once, however many copies it has. The coordinates are cut into
bands; classes that agree in a band are candidates. Each class is checked
against the hub of each of its bands (the class that meets most others), on the
full sets, and linked classes are joined to components. Pairs of one band that
are still in different components are checked as well, unless their sizes, the
shingles that only one class has, or the rare ones they don't share rule a link
out. So no candidate that could
change a component is left out, and a band with thousands of near copies costs
one check each rather than one for each pair.

With 24 bands of 4, a pair at the limit of 0.8 shares no band with a chance of
3 in a million; closer pairs less.

Nulls and empty texts have an empty set and are linked with nothing. Repeated
rows are copies. An id that several rows carry names the component of each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.llm.graph import components
from fleetspan.llm.words import BASE, SECOND, SMALL_PIECE, fresh, mixed, pieces, row_key, run_hashes, signed, words_of
from fleetspan.plans.shared import staged

SHINGLE = 5
SIMILARITY = 80
"""In hundredths."""
BANDS, ROWS = 24, 4
RARE = 100
"""Classes that may share a rare shingle, at most."""


def _permuted(x: np.ndarray, out: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit values (a bit mixer), into ``out``."""
    spare = x >> np.uint32(16)
    np.bitwise_xor(x, spare, out=out)
    out *= np.uint32(0x7FEB352D)
    np.right_shift(out, np.uint32(15), out=spare)
    out ^= spare
    out *= np.uint32(0x846CA68B)
    np.right_shift(out, np.uint32(16), out=spare)
    out ^= spare
    return out


def signatures(shingles: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """One row of ``count`` coordinates for each set shingles[first[d]:first[d + 1]] (none empty)."""
    places = (mixed(shingles ^ SECOND) >> np.uint64(32)).astype(np.uint32)
    result = np.empty((len(first) - 1, count), np.uint32)
    step = 1 << 16
    cuts = [0]
    while cuts[-1] < len(first) - 1:  # sets in blocks that stay in the cache
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(first, first[cuts[-1]] + step, side="right")) - 1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        block = places[first[a] : first[b]]
        starts = first[a:b] - first[a]
        out = np.empty_like(block)
        for c in range(count):
            result[a:b, c] = np.minimum.reduceat(_permuted(block - np.uint32(c), out), starts)
    return result


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, and where each text's begin."""
    words = words_of(texts, lower=True)
    value = words.hashes()
    n_words = np.diff(words.first)
    at = words.run_starts(k)
    runs = run_hashes(value, at, at + k)
    bounds = np.searchsorted(at, words.first)
    sets = []
    for d, n in enumerate(n_words):
        if n >= k:
            sets.append(np.unique(runs[bounds[d] : bounds[d + 1]]))
        else:
            begin = words.first[d : d + 1]
            sets.append(run_hashes(value[begin[0] : begin[0] + n], np.zeros(1, int), np.full(1, n)) if n else value[:0])
    first = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if sets else value[:0]), first


def _scan(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, most=SMALL_PIECE):
            shingles, first = shingle_sets(piece.column("text"), k)
            size = np.diff(first)
            full = np.flatnonzero(size)
            starts = np.append(first[full], len(shingles)).astype(np.int64)
            node = np.zeros(len(size), np.uint64)
            keys = np.zeros((len(full), bands), np.uint64)
            if len(full):
                total = np.add.reduceat(mixed(shingles), starts[:-1])
                cross = np.bitwise_xor.reduceat(mixed(shingles ^ SECOND), starts[:-1])
                node[full] = mixed(total ^ mixed(cross + size[full].astype(np.uint64)))
                sign = signatures(shingles, starts, bands * rows).astype(np.uint64)
                for b in range(bands):
                    key = np.full(len(full), np.uint64(b + 1)) * BASE
                    for r in range(rows):
                        key = mixed(key ^ sign[:, b * rows + r]) * SECOND
                    keys[:, b] = key
            lists = np.zeros(len(size) + 1, np.int32)
            lists[1:] = np.cumsum(np.where(size > 0, bands, 0))
            arrays = [piece.column("row"), piece.column("doc_id"), pa.array(size, pa.int64()), signed(node)]
            arrays.append(pa.ListArray.from_arrays(pa.array(lists), signed(keys.reshape(-1))))
            yield pa.record_batch(arrays, names=["row", "doc_id", "n", "node", "bands"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, most=SMALL_PIECE):
            shingles, first = shingle_sets(piece.column("text"), k)
            sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), signed(shingles))
            yield pa.record_batch([piece.column("node"), sets], names=["node", "shingles"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(right, "b").join(left, "a").withColumn("shared", F.size(F.array_intersect("x", "y")))
    union = F.size("x") + F.size("y") - F.col("shared")
    return both.where(100 * F.col("shared") >= similarity * union).select("a", "b")


def _unsettled(keyed: DataFrame, parts: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Rows (band, node, n, own, part) of the classes that a link inside their band could still bring to another component.

    ``own`` counts the shingles that no other such class has. Two classes share
    at most what isn't their own, so a class with many can't be linked to one of
    a given size, nor to any that is larger.
    """
    mixed_bands = lambda rows: rows.groupBy("band").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.min("n").alias("least")).where("x <> y")
    placed = keyed.join(parts, "node", "left").select("band", "node", "n", F.coalesce("component", "node").alias("part"))
    rest = staged(placed.join(staged(mixed_bands(placed).select("band"), "mixed"), "band"), "mixed-bands")
    members = rest.select("node").distinct()
    each = sets.join(members, "node").select("node", F.explode("shingles").alias("shingle"))
    own = each.groupBy("shingle").agg(F.count("*").alias("classes"), F.min("node").alias("node")).where("classes = 1")
    own = own.groupBy("node").agg(F.count("*").alias("own"))
    rest = staged(rest.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0))).where(f"100 * (n - own) >= {similarity} * n"), "unsettled")
    least = staged(mixed_bands(rest).select("band", "least"), "mixed")
    rest = staged(rest.join(least, "band").where(f"{100 + similarity} * (n - own) >= {similarity} * (n + least)").drop("least"), "unsettled")
    return staged(rest.join(staged(mixed_bands(rest).select("band"), "mixed"), "band"), "unsettled")


def _pairs_left(rest: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a < b) of unsettled classes in different components that could be linked.

    A shingle is rare if at most ``RARE`` of these classes have it. If two classes
    could not be linked by the other shingles of one of them, they must share a
    rare one, and one of the first few in the order of rareness. So such partners
    are found by rare shingles, a bounded number for each; the others meet in bands.
    """
    members = staged(rest.groupBy("node").agg(F.first("n").alias("n"), F.first("part").alias("part")), "members")
    each = sets.join(members, "node").select("node", "n", "part", F.explode("shingles").alias("shingle"))
    rare = staged(each.groupBy("shingle").agg(F.count("*").alias("classes")).where(f"classes <= {RARE}"), "rare")
    rare = staged(each.join(rare, "shingle"), "rare-of")
    order = Window.partitionBy("node").orderBy("classes", "shingle")
    smallest = F.ceil(F.col("n") * similarity / 100)
    needed = F.col("n") - F.ceil((F.col("n") + smallest) * similarity / (100 + similarity)) + 1
    asking = rare.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= needed)
    asking = asking.select("shingle", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("part").alias("part_a"))
    asked = rare.select("shingle", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("part").alias("part_b"))
    sized = f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    by_rare = asking.join(asked, "shingle").where("part_a <> part_b").where(sized).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    counts = staged(rare.groupBy("node").agg(F.count("*").alias("rare")), "rare-counts")
    rest = rest.join(counts, "node", "left").select("band", "node", "n", "part", F.coalesce("rare", F.lit(0)).alias("rare"))
    rest = staged(rest, "rest")
    bands = rest.groupBy("band").agg(F.min("n").alias("least"))
    rest = staged(rest.join(staged(bands, "least"), "band").where(f"{100 + similarity} * (n - rare) >= {similarity} * (n + least)"), "rest")
    still = rest.groupBy("band").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("band")
    rest = rest.join(staged(still, "mixed"), "band")
    rest = staged(rest.withColumn("bands", F.collect_set("band").over(Window.partitionBy("node"))), "rest")
    side = lambda x: rest.select("band", F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "rare", "part", "bands")])
    possible = f"{100 + similarity} * least(n_a - rare_a, n_b - rare_b) >= {similarity} * (n_a + n_b)"
    once = "band = array_min(array_intersect(bands_a, bands_b))"  # of the bands that a pair shares one names it
    in_band = side("a").join(side("b"), "band").where(f"a < b and part_a <> part_b and {possible} and {once}").select("a", "b")
    return in_band.union(by_rare).distinct()


def near_components(docs: DataFrame, k: int, similarity: int, bands: int, rows: int) -> DataFrame:
    """row, doc_id, n_shingles, component_id and part (the component itself; null for an empty set) for rows (row, doc_id, text)."""
    scan = staged(docs.mapInArrow(_scan(k, bands, rows), "row long, doc_id long, n long, node long, bands array<long>"), "signatures")
    full = scan.where("n > 0")
    classes = full.groupBy("node").agg(F.min("doc_id").alias("low"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = staged(classes, "classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.count("*").alias("in_band")).where("in_band > 1")
    shared = staged(shared, "shared-bands")  # a table of its own, so the join can split a crowded band
    keyed = staged(keyed.join(shared, "band"), "bands")
    known = staged(keyed.groupBy("node").agg(F.sum("in_band").alias("company")), "company")
    hubs = keyed.join(known, "node").groupBy("band").agg(F.max(F.struct("company", "node")).getField("node").alias("a"))
    hubs = staged(hubs, "hubs")
    nodes = keyed.select("node").distinct().join(classes.select("node", "row"), "node")
    sets = docs.select("row", "text").join(nodes, "row").dropDuplicates(["node"])
    sets = staged(sets.mapInArrow(_sets(k), "node long, shingles array<long>"), "sets")
    sized = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    stars = keyed.join(hubs, "band").where("node <> a").select("a", F.col("node").alias("b"), F.col("n").alias("n_b")).distinct()
    possible = f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    stars = stars.join(sized, "a").where(possible).select("a", "b")
    links = staged(_linked(stars, sets, similarity), "links")
    parts = components(links)
    rest = _unsettled(keyed.select("band", "node", "n"), parts, sets, similarity)
    pairs = staged(_pairs_left(rest, sets, similarity), "pairs")
    more = staged(_linked(pairs, sets, similarity), "more-links")
    if not more.isEmpty():
        parts = components(links.union(more))
    labelled = classes.select("node", "low").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    names = labelled.groupBy("part").agg(F.min("low").alias("component_id"))
    named = labelled.join(names, "part").select("node", "part", "component_id")
    joined = scan.select("row", "doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    return joined.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "part")


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(row_key(doc_id, text).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the linked documents) and kept, for every row."""
    found = near_components(_rows(df, doc_id, text), k, similarity, bands, rows)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of one document of each group; of rows that repeat an id and a text one stays."""
    found = near_components(_rows(df, doc_id, text), k, similarity, bands, rows)
    key = fresh(df, "row_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    kept = found.where(F.col("n_shingles") > 0).groupBy("part").agg(first.alias("first")).select(F.col("first.row").alias(key))
    empty = found.where(F.col("n_shingles") == 0).select(F.col("row").alias(key)).distinct()
    rows_ = df.withColumn(key, row_key(doc_id, text))
    return rows_.join(kept.union(empty), key, "left_semi").dropDuplicates([key]).select(*df.columns)
