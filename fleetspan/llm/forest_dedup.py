"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree cuts its rows in two at the middle of a random projection, again and
again; rows near a cut go to both sides, so close vectors rarely part. Many trees
with different projections make up for those that do.

Equal vectors are one node. The tops of all trees are fitted on a bounded sample
of nodes (``SAMPLE``, by hash) and every node is sent down them in one pass. A
cell that still holds more than ``CELL`` rows is cut again in the same way, by a
top fitted on a sample of its own, until no cell is larger; in a cell the
recursion goes on to leaves of ``LEAF``. Leaves are compared within; every pair
is checked by its cosine in double precision, and links are joined to components.

Where a group is larger than a leaf and its vectors are all near each other, a
cut parts pairs at random, so the trees lose links. A node that has more than
``DENSE`` links in one leaf therefore gets its links by comparison instead.
Pivots are taken until each dense node is close to one (a sample of ``SAMPLE``
open nodes a round; the pivots are held in the driver and sent to the tasks). By
the triangle inequality all links of a pivot's group lie in a ball around it;
group and ball are compared whole, block against block, one task for a pair of
blocks. That finds every link of a dense node. Only sums and a link to the pivot
leave a block, so a group makes no row for each pair.

Rows of nearly one direction (multiples of a vector, say) are not parted by any cut.
A cut that leaves too many rows on both sides is not made, cell by cell; what is in a
cell of more than a leaf that can't be cut counts as dense. So cutting ends on any input.

Other links are counted for different vectors (a pair is one row, however many
leaves found it); copies of a vector add to the counts without a row for each pair.

Null, zero and non-finite vectors link with nothing. Vectors of different lengths
never link. Repeated rows are copies. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.graph import components
from fleetspan.llm.vectors import matrix, rows_of
from fleetspan.llm.words import BASE, mixed
from fleetspan.plans.shared import staged

COSINE = 0.9
TREES = 10
SAMPLE = 4096
CELL = 8192
LEAF = 512
SPILL = 0.06
"""Share of a node's rows on either side of a cut that go to both sides."""
DENSE = LEAF // 4
"""A node with more links than this in one leaf is compared with all that can be near it."""
BLOCK, LEAST_BLOCK, BLOCKS = 8192, 256, 8
"""Rows of a block at most; a group of over ``LEAST_BLOCK`` rows is cut into blocks, ``BLOCKS`` as long as none gets too large."""
WORTH, SMALLER = 1.3, 0.9
"""A cut is made if both sides together hold at most so many times its rows, and the larger side this share."""
TOP_LEAF = 64
"""Sample rows in a cell of a top, at least."""


def _direction(tree: int, cell: int, size: int) -> np.ndarray:
    """The random projection of a tree node, the same wherever it is needed."""
    seed = mixed(np.array([(cell * 1009 + tree + 1) % (1 << 64)], np.uint64) * BASE)[0]
    return np.random.default_rng(int(seed)).standard_normal(size)


def _cut(x: np.ndarray, tree: int, cell: int) -> tuple[np.ndarray, float, float]:
    along = x @ _direction(tree, cell, x.shape[1])
    return along, *np.quantile(along, [0.5 + SPILL, 0.5 - SPILL])


def _parted(along: np.ndarray, left: float, right: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows of either side, or None if the cut doesn't part them."""
    sides = np.flatnonzero(along <= left), np.flatnonzero(along >= right)
    sizes = [len(side) for side in sides]
    return sides if sum(sizes) <= WORTH * len(along) and max(sizes) <= SMALLER * len(along) else None


def fit_top(x: np.ndarray, tree: int, cell: int, least: int = TOP_LEAF) -> dict[int, tuple[float, float]]:
    """Cuts of a tree above cells of at least ``least`` sample rows: node -> bounds of its left and right side."""
    cuts, open_ = {}, [(cell, x)]
    while open_:
        at, rows = open_.pop()
        if len(rows) < 2 * least:
            continue
        along, left, right = _cut(rows, tree, at)
        if (sides := _parted(along, left, right)) is not None:
            cuts[at] = (left, right)
            open_ += [(2 * at, rows[sides[0]]), (2 * at + 1, rows[sides[1]])]
    return cuts


def send_down(x: np.ndarray, tree: int, cell: int, cuts: dict[int, tuple[float, float]]) -> Iterator[tuple[int, np.ndarray]]:
    """The rows that reach each cell below the cuts."""
    open_ = [(cell, np.arange(len(x)))]
    while open_:
        at, rows = open_.pop()
        if at not in cuts or not len(rows):
            yield at, rows
            continue
        along = x[rows] @ _direction(tree, at, x.shape[1])
        left, right = cuts[at]
        open_ += [(2 * at, rows[along <= left]), (2 * at + 1, rows[along >= right])]


def leaf_pairs(x: np.ndarray, tree: int, cell: int, cosine: float, leaf: int = LEAF, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i < j) that share a leaf and are close, each once, and the dense rows; pairs of rows dense in a leaf are left out there."""
    pairs, crowded, open_ = [np.zeros((2, 0), int)], np.zeros(len(x), bool), [(cell, np.arange(len(x)))]
    while open_:
        at, rows = open_.pop()
        if len(rows) > leaf:
            sides = _parted(*_cut(x[rows], tree, at % (1 << 62)))
            if sides is None:
                crowded[rows] = True
            else:
                open_ += [(2 * at, rows[sides[0]]), (2 * at + 1, rows[sides[1]])]
            continue
        near = x[rows] @ x[rows].T >= cosine
        crowd = near.sum(1) > dense + 1
        crowded[rows[crowd]] = True
        rows, near = rows[~crowd], near[np.ix_(~crowd, ~crowd)]
        i, j = rows[np.nonzero(near)[0]], rows[np.nonzero(near)[1]]
        pairs.append(np.stack([i, j])[:, i < j])
    return np.unique(np.concatenate(pairs, axis=1), axis=1), np.flatnonzero(crowded)


def _cells(tops: dict[int, dict[int, dict[int, tuple[float, float]]]]):
    """Rows (node, vector) to rows (cell key, node, vector) of every tree; tops by vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                sizes = batch.column("vector").value_lengths().to_numpy()
                for size in np.unique(sizes):
                    part = batch.filter(pa.array(sizes == size))
                    x = matrix(part.column("vector"))
                    for tree in range(TREES):
                        for cell, rows in send_down(x, tree, 1, tops.get(int(size), {}).get(tree, {})):
                            if len(rows):
                                kept = part.take(pa.array(rows))
                                n = pa.array(np.full(len(rows), size), pa.int32())
                                yield pa.record_batch([n, pa.array(np.full(len(rows), tree), pa.int32()), pa.array(np.full(len(rows), cell, np.int64)), kept.column("node"), kept.column("vector")], names=["size", "tree", "cell", "node", "vector"])

    return run


_CELL = "size int, tree int, cell long, node long, vector array<double>"


def _cut_again(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Cut every cell of more than ``most`` rows by a top fitted on a sample of it; the rows, and the nodes of cells that can't be cut."""
    keys = ["size", "tree", "cell"]
    whole = rows.select("node").where("false")
    while True:
        large = staged(rows.groupBy(keys).agg(F.count("*").alias("n")).where(F.col("n") > most), "large-cells")
        if large.isEmpty():
            return rows, whole
        marked = rows.join(large, keys, "left")
        rate = F.lit(float(SAMPLE)) / F.col("n")
        drawn = marked.where(F.col("n").isNotNull() & (F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < rate * (1 << 30)))

        def fit(key, pdf):
            import pandas as pd

            cuts = fit_top(np.stack(pdf["vector"].to_numpy()), int(key[1]), int(key[2]))
            flat = [[at, left, right] for at, (left, right) in cuts.items()]
            return pd.DataFrame({"size": [key[0]], "tree": [key[1]], "cell": [key[2]], "cuts": [[v for row in flat for v in row]]})

        names = [c.split()[0] for c in _CELL.split(", ")]
        tops = staged(drawn.select(names).groupBy(keys).applyInPandas(fit, "size int, tree int, cell long, cuts array<double>"), "tops")
        joined = marked.join(tops, keys, "left").select(*names, "cuts", F.col("n").isNotNull().alias("again"))
        stuck = F.col("again") & (F.coalesce(F.size("cuts"), F.lit(0)) == 0)
        whole = staged(whole.union(joined.where(stuck).select("node")).distinct(), "whole-cells")

        def go_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                frame = batch.select(["size", "tree", "cell", "again"]).to_pandas()
                for (size, tree, cell, again), part in frame.groupby(["size", "tree", "cell", "again"]):
                    rows = batch.take(pa.array(part.index.to_numpy()))
                    flat = np.array(rows.column("cuts")[0].as_py() or []).reshape(-1, 3)
                    cuts = {int(a): (left, right) for a, left, right in flat} if again else {}
                    for to, kept in send_down(matrix(rows.column("vector")), int(tree), int(cell), cuts):
                        part_ = rows.take(pa.array(kept))
                        n = len(kept)
                        yield pa.record_batch([pa.array(np.full(n, size), pa.int32()), pa.array(np.full(n, tree), pa.int32()), pa.array(np.full(n, to, np.int64)), part_.column("node"), part_.column("vector")], names=names)

        rows = staged(joined.where(~stuck).mapInArrow(go_down, _CELL), "cells")


def _by_length(batches: Iterator[pa.RecordBatch], step: int = 2048) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows with vectors of one length, a bounded number at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            batch = whole.slice(at, step)
            sizes = batch.column("vector").value_lengths().to_numpy()
            for size in np.unique(sizes):
                yield int(size), batch.filter(pa.array(sizes == size))


def _cover(x: np.ndarray, cosine: float) -> np.ndarray:
    """Rows that every row is close to, those close to most first."""
    near = np.concatenate([x[a : a + LEAF] @ x.T >= cosine for a in range(0, len(x), LEAF)])
    free, chosen = np.ones(len(x), bool), []
    for at in np.argsort(-near.sum(1), kind="stable"):
        if free[at]:
            chosen.append(at)
            free &= ~near[at]
            free[at] = False
    return np.array(chosen)


def _groups(open_: DataFrame, cosine: float) -> tuple[DataFrame, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """A close pivot (and the cosine to it) for each node, and the pivots by vector length: nodes and vectors."""
    pivots, members = {}, None
    while True:
        sample = open_.orderBy(F.xxhash64("node", F.lit(2)), "node").limit(SAMPLE).toPandas()  # SAMPLE rows at most
        if not len(sample):
            return members, {size: (np.concatenate([n for n, _ in new]), np.concatenate([x for _, x in new])) for size, new in pivots.items()}
        fresh = {}
        for size, part in sample.groupby(sample["vector"].map(len)):
            x = np.stack(part["vector"].to_numpy())
            chosen = _cover(x, cosine)
            fresh[int(size)] = part["node"].to_numpy()[chosen], x[chosen]
            pivots.setdefault(int(size), []).append(fresh[int(size)])

        def assign(batches: Iterator[pa.RecordBatch], fresh=fresh) -> Iterator[pa.RecordBatch]:
            for size, batch in _by_length(batches):
                names, x = fresh.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
                pivot, along = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, -2.0)
                if len(names):
                    product = matrix(batch.column("vector")) @ x.T
                    product[batch.column("node").to_numpy()[:, None] == names[None, :]] = 2
                    best = product.argmax(1)
                    pivot, along = names[best], product[np.arange(len(best)), best]
                yield pa.record_batch([batch.column("node"), batch.column("vector"), pa.array(pivot, mask=along < cosine), pa.array(np.minimum(along, 1))], names=["node", "vector", "pivot", "along"])

        marked = staged(open_.mapInArrow(assign, "node long, vector array<double>, pivot long, along double"), "groups")
        found = marked.where("pivot is not null").select("node", "pivot", "along")
        members = found if members is None else members.union(found)
        open_ = marked.where("pivot is null").select("node", "vector")


def _balls(pivots: dict[int, tuple[np.ndarray, np.ndarray]], least: dict[int, float], cosine: float):
    """Rows to a row for each ball they lie in: what is close to a row of the pivot's group is in its ball."""
    bounds = {size: np.cos(np.minimum(np.pi, np.arccos(np.clip([least[int(n)] for n in names], -1, 1)) + np.arccos(min(cosine, 1)) + 1e-6)) for size, (names, _) in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, batch in _by_length(batches):
            if size not in pivots:
                continue
            names, x = pivots[size]
            rows, balls = np.nonzero(matrix(batch.column("vector")) @ x.T >= bounds[size])
            for a in range(0, len(rows), 8192):
                kept = batch.take(pa.array(rows[a : a + 8192]))
                yield pa.record_batch([pa.array(names[balls[a : a + 8192]]), *(kept.column(c) for c in ("node", "vector", "copies", "pivot"))], names=["ball", "node", "vector", "copies", "pivot"])

    return run


def _dense_links(unit: DataFrame, crowded: DataFrame, cosine: float) -> DataFrame:
    """(node, n, to) for all links of dense nodes: parts of a node's sum of copies, each with a node of its component.

    unit: node, vector, copies. Links of other nodes count here only where the other end is dense.
    """
    members, pivots = _groups(staged(unit.join(crowded, "node", "left_semi").select("node", "vector"), "dense"), cosine)
    least = {r["pivot"]: r["low"] for r in members.groupBy("pivot").agg(F.min("along").alias("low")).collect()}  # a row for each pivot
    marked = unit.select("node", "vector", "copies").join(members.select("node", "pivot"), "node", "left")
    rows = staged(marked.mapInArrow(_balls(pivots, least, cosine), "ball long, node long, vector array<double>, copies long, pivot long"), "balls")
    blocks = lambda n: F.greatest(F.least(F.lit(BLOCKS), F.ceil(n / LEAST_BLOCK)), F.ceil(n / BLOCK))
    sizes = rows.groupBy("ball").agg(blocks(F.count("*")).alias("width"), blocks(F.count_if(F.col("pivot") == F.col("ball"))).alias("height"))
    rows = rows.join(staged(sizes, "ball-sizes"), "ball")
    own = lambda k: F.pmod(F.xxhash64("node", F.lit(5)), F.col(k))
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    columns = ["ball", "node", "vector", "copies", "pivot"]
    group = rows.where("pivot = ball").select(*columns, F.lit(True).alias("inside"), own("height").alias("i"), each("width").alias("j"))
    around = rows.select(*columns, F.lit(False).alias("inside"), own("width").alias("j"), each("height").alias("i"))

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        inside = table.column("inside").to_numpy().astype(bool)
        x, node, copies = matrix(table.column("vector")), table.column("node").to_numpy(), table.column("copies").to_numpy()
        free = table.column("pivot").is_null().to_numpy()
        pivot = table.column("pivot").fill_null(0).to_numpy()
        left, right = np.flatnonzero(inside), np.flatnonzero(~inside)
        sums, others, met = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64), np.zeros(len(right), bool)
        for a in range(0, len(left), LEAF):
            at = left[a : a + LEAF]
            close = (x[at] @ x[right].T >= cosine) & (node[at][:, None] != node[right][None, :])
            sums[a : a + LEAF] = close @ copies[right]
            others += copies[at] @ close
            met |= close.any(0)
        left, sums = left[sums > 0], sums[sums > 0]
        alone = met & free[right]
        touched = np.unique(pivot[right[met & ~free[right]]])
        to = np.concatenate([node[left], node[right[alone]], touched])
        n = np.concatenate([sums, others[alone], np.zeros(len(touched), np.int64)])
        return pa.table({"node": to, "n": n, "to": np.full(len(to), key[0].as_py(), np.int64)})

    units = group.unionByName(around).groupBy("ball", "i", "j")
    return staged(units.applyInArrow(count, "node long, n long, to long"), "dense-links")


def links(nodes: DataFrame, cosine: float = COSINE, cell: int = CELL) -> tuple[DataFrame, DataFrame | None]:
    """Links of nodes (node, vector, copies; all different): close pairs (a < b) of nodes that aren't dense, and sums for the others (``_dense_links``)."""
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    largest = F.array_max(F.transform("vector", F.abs))
    scaled = nodes.withColumn("vector", F.transform("vector", lambda x: x / largest))  # lengths neither vanish nor overflow
    unit = staged(scaled.select("node", F.transform("vector", lambda x: x / length).alias("vector"), "copies"), "units")
    tops = {}
    sample = unit.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(SAMPLE).toPandas()  # SAMPLE rows at most
    for size, part in sample.groupby(sample["vector"].map(len)) if len(sample) else ():
        x = np.stack(part["vector"].to_numpy())
        tops[int(size)] = {tree: fit_top(x, tree, 1) for tree in range(TREES)}
    rows, whole = _cut_again(staged(unit.select("node", "vector").mapInArrow(_cells(tops), _CELL), "cells"), cell)

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        pairs, crowded = leaf_pairs(matrix(table.column("vector")), key[1].as_py(), key[2].as_py(), cosine)
        a, b = node[pairs[0]], node[pairs[1]]
        none = np.zeros(len(crowded), np.int64)
        b = pa.array(np.concatenate([np.maximum(a, b), none]), mask=np.arange(len(b) + len(none)) >= len(b))
        return pa.table({"a": np.concatenate([np.minimum(a, node[pairs[1]]), node[crowded]]), "b": b})

    found = staged(rows.groupBy("size", "tree", "cell").applyInArrow(compare, "a long, b long").distinct(), "found")
    pairs = found.where("b is not null")
    crowded = staged(found.where("b is null").select(F.col("a").alias("node")).union(whole).distinct(), "crowded")
    if crowded.isEmpty():
        return pairs, None
    for end in ("a", "b"):
        pairs = pairs.join(crowded.withColumnRenamed("node", end), end, "left_anti")
    return staged(pairs.select("a", "b"), "links"), _dense_links(unit, crowded, cosine)


def near_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = staged(rows_of(df, vec_id, embedding), "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    nodes = staged(nodes, "nodes")
    pairs, dense = links(nodes.select("node", "vector", "copies"), cosine, cell)
    both = pairs.union(pairs.select(F.col("b"), F.col("a")))
    copies = nodes.select(F.col("node").alias("b"), "copies")
    counts = both.join(copies, "b").select(F.col("a").alias("node"), F.col("copies").alias("n"))
    if dense is not None:
        counts = counts.union(dense.select("node", "n"))
        pairs = pairs.union(dense.select("node", "to"))
    linked = counts.groupBy("node").agg(F.sum("n").alias("others"))
    parts = components(pairs)
    known = nodes.select("node", "copies", "low").join(linked, "node", "left").join(parts, "node", "left")
    known = known.withColumn("part", F.coalesce("component", "node"))
    names = known.groupBy("part").agg(F.min("low").alias("component_id"))
    known = known.join(names, "part").select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "component_id")
    joined = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
