"""Nearest neighbours by stable projections, a kd-tree and a chi-square stop.

The largest inner product is made the smallest distance by one more coordinate,
which brings all candidates to one length. A Gaussian projection to ``DIMENSIONS``
coordinates keeps distances in this sense: squared projected over squared true
distance has a chi-square distribution. The candidates' projections are indexed
by a kd-tree. A query sees its candidates leaf by leaf, nearest projected box
first, checks each on the original vectors, and stops at the box so far away
that a better candidate would project beyond it with probability ``SURE`` only.

The kd-tree is fitted from the top on bounded samples: as many cells as the rows ask for
(``CELLS`` at most at once), and a cell that still holds more than ``BLOCK`` rows is cut
again by a tree fitted on a sample of its own. Only equal points, which no cut parts,
are cut by hash. So blocks, and the boxes that the tasks are given, grow in proportion
to the rows (some 200 bytes for ``BLOCK`` of them). Inside a block the tree goes on to leaves.

A query is first answered in the block it falls into; what it finds bounds which other boxes
the stopping test leaves, and it is sent to these only. A block that more than ``BLOCK``
queries visit stands in several tasks, each with a part of them; no other candidate is copied,
and neither side is ever whole in a task. Every row is a candidate.

Null, zero and non-finite vectors and rows without an id take no part, nor do candidates whose
length isn't the query's. Repeated rows are candidates of their own; ties go to the smaller id.
An empty table gives an empty result; other columns, clashing names included, are not looked at.
"""

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.llm.vectors import matrix, rows_of
from fleetspan.plans.shared import staged

NEAREST = 20
EVERY = 20
"""Rows whose id is divisible by this are the queries."""
DIMENSIONS = 10
SURE = 0.98
SAMPLE = 8192
CELLS = 256
"""Cells that one sample is cut into at most; rows keep 32 sample rows a cell at least."""
BLOCK = 8192
LEAF = 64


def chi_square_quantile(p: float, k: int) -> float:
    """The value that a chi-square variable of k degrees of freedom stays under with probability p."""
    def below(x: float) -> float:  # the regularized lower gamma function, by its series
        a, x = k / 2, x / 2
        term = total = 1 / a
        n = a
        while term > 1e-16 * total:
            n += 1
            term *= x / n
            total += term
        return total * np.exp(a * np.log(x) - x - lgamma(a))

    low, high = 1e-9, 20.0 * k + 200
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class Projection:
    """Projected coordinates of vectors of one length; ``largest`` is the largest norm of a candidate."""

    def __init__(self, size: int, largest: float):
        self.matrix = np.random.default_rng(size + 11).standard_normal((size + 1, DIMENSIONS))
        self.largest = largest

    def candidates(self, x: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(0.0, self.largest**2 - (x * x).sum(1)))
        return x @ self.matrix[:-1] + last[:, None] * self.matrix[-1]

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1]

    def distance(self, query: np.ndarray, product: np.ndarray) -> np.ndarray:
        """Squared distance of a query to a candidate with this inner product."""
        return np.maximum(0.0, (query * query).sum(-1) + self.largest**2 - 2 * product)


def kd_leaves(y: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of the leaves of a kd-tree: cut at the median of the widest coordinate."""
    leaves, open_ = [], [np.arange(len(y))]
    while open_:
        rows = open_.pop()
        if len(rows) <= most:
            leaves.append(rows)
            continue
        part = y[rows]
        axis = int(np.argmax(part.max(0) - part.min(0)))
        order = np.argsort(part[:, axis], kind="stable")
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return leaves


def box_distance(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of one point to boxes."""
    off = np.maximum(0.0, np.maximum(low - query, query - high))
    return (off * off).sum(1)


class Cells:
    """An upper kd-tree with a given number of cells (a power of two); node i has nodes 2i and 2i + 1 below it."""

    def __init__(self, y: np.ndarray, cells: int):
        self.levels = cells.bit_length() - 1
        self.axis, self.at = np.zeros(cells, int), np.zeros(cells)
        rows = {1: y}
        for node in range(1, cells):
            part = rows.pop(node)
            if len(part):
                self.axis[node] = np.argmax(part.max(0) - part.min(0))
                self.at[node] = np.median(part[:, self.axis[node]])
            left = part[:, self.axis[node]] <= self.at[node]
            rows[2 * node], rows[2 * node + 1] = part[left], part[~left]
        self._boxes(y.shape[1])

    @classmethod
    def of_cuts(cls, axis: np.ndarray, at: np.ndarray, dimensions: int) -> "Cells":
        """The tree with these cuts."""
        cells = cls.__new__(cls)
        cells.levels, cells.axis, cells.at = len(axis).bit_length() - 1, axis, at
        cells._boxes(dimensions)
        return cells

    def _boxes(self, dimensions: int) -> None:
        cells = len(self.axis)
        self.low = np.full((cells, dimensions), -np.inf)
        self.high = np.full((cells, dimensions), np.inf)
        for cell in range(cells):
            node = cells + cell
            while node > 1:
                side, node = node % 2, node // 2
                axis, at = self.axis[node], self.at[node]
                if side:
                    self.low[cell, axis] = max(self.low[cell, axis], at)
                else:
                    self.high[cell, axis] = min(self.high[cell, axis], at)

    def of(self, y: np.ndarray) -> np.ndarray:
        node = np.ones(len(y), int)
        for _ in range(self.levels):
            node = 2 * node + (y[np.arange(len(y)), self.axis[node]] > self.at[node])
        return node - len(self.axis)


def cell_count(rows: int, block: int) -> int:
    """Cells for so many rows, so that most hold less than a block."""
    cells = 1
    while cells < CELLS and cells * block < 2 * rows:
        cells *= 2
    return cells


class Tree:
    """Cells below cells, for vectors of one length. The cell of key k has those of keys k * 2 * CELLS + 1 + c below it."""

    def __init__(self, projection: Projection, top: Cells):
        self.projection, self.cells = projection, {1: top}
        self.parts: dict[int, int] = {}  # blocks of a cell of equal points, by hash
        self.seal()

    def seal(self) -> None:
        """Leaves and their boxes."""
        keys, low, high, open_ = [], [], [], [(1, -np.inf, np.inf)]
        while open_:
            key, above_low, above_high = open_.pop()
            cells = self.cells[key]
            for c in range(len(cells.low)):
                child, box = key * 2 * CELLS + 1 + c, (np.maximum(cells.low[c], above_low), np.minimum(cells.high[c], above_high))
                if child in self.cells:
                    open_.append((child, *box))
                else:
                    keys.append(child)
                    low.append(box[0])
                    high.append(box[1])
        self.leaves, self.low, self.high = np.array(keys), np.stack(low), np.stack(high)

    def of(self, y: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        key, open_ = np.ones(len(y), np.int64), np.arange(len(y))
        while len(open_):
            for k in np.unique(key[open_]):
                at = open_[key[open_] == k]
                key[at] = k * 2 * CELLS + 1 + self.cells[int(k)].of(y[at])
            open_ = open_[np.isin(key[open_], list(self.cells))]
        return key

    def blocks(self, leaf: int) -> list[tuple[int, int]]:
        return [(leaf, part) for part in range(self.parts.get(leaf, 1))]


class Block:
    """Candidates of one block under their own kd-tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, projection: Projection):
        y = projection.candidates(x)
        leaves = kd_leaves(y, LEAF)
        order = np.concatenate(leaves)
        self.projection, self.x, self.ids, self.rows = projection, x[order], ids[order], rows[order]
        self.bounds = np.cumsum([0, *map(len, leaves)])
        self.low = np.stack([y[leaf].min(0) for leaf in leaves])
        self.high = np.stack([y[leaf].max(0) for leaf in leaves])

    def search(self, query: np.ndarray, own: int, floor: float, most: int, stretch: float) -> tuple[np.ndarray, np.ndarray]:
        """The best (ids, products) for a query that knows ``most`` others with products of ``floor`` or more."""
        far = box_distance(self.projection.queries(query[None])[0], self.low, self.high)
        order = np.argsort(far, kind="stable")
        ids, products, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 4
        while at < len(order):
            limit = stretch * self.projection.distance(query, floor) if floor > -np.inf else np.inf
            leaves = order[at : at + step]
            leaves = leaves[far[leaves] <= limit]
            if not len(leaves):
                break
            rows = np.concatenate([np.arange(self.bounds[b], self.bounds[b + 1]) for b in leaves])
            rows = rows[self.rows[rows] != own]
            product = self.x[rows] @ query
            good = product >= floor
            ids, products = np.append(ids, self.ids[rows[good]]), np.append(products, product[good])
            best = np.lexsort((ids, -products))[:most]
            ids, products = ids[best], products[best]
            if len(ids) == most:
                floor = max(floor, float(products[-1]))
            at, step = at + step, 2 * step
        return ids, products


def _visits(index: dict[int, Tree], stretch: float):
    """Queries to a row for each block they visit: the one they fall into (``floor`` null), else the others that the stopping test leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x, tree = matrix(part.column("vector")), index[int(size)]
                y = tree.projection.queries(x)
                home = tree.of(y).tolist()
                for i, floor in enumerate(part.column("floor").to_pylist()):
                    leaves = [home[i]]
                    if floor is not None:
                        limit = stretch * tree.projection.distance(x[i], floor) if floor > -np.inf else np.inf
                        leaves = [k for k in tree.leaves[box_distance(y[i], tree.low, tree.high) <= limit].tolist() if k != home[i]]
                    blocks = [b for leaf in leaves for b in tree.blocks(leaf)]
                    if blocks:
                        n = len(blocks)
                        own = part.slice(i, 1).take(pa.array(np.zeros(n, np.int64)))
                        places = [pa.array(np.full(n, size), pa.int32()), pa.array([b[0] for b in blocks], pa.int64()), pa.array([b[1] for b in blocks], pa.int32())]
                        yield pa.record_batch([*places, *(own.column(c) for c in ("row", "vec_id", "vector", "floor"))], names=["size", "leaf", "part", "row", "vec_id", "vector", "floor"])

    return run


def _candidate_leaves(index: dict[int, Tree]):
    """Rows with the leaf that they fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            leaf = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes):
                at, tree = np.flatnonzero(sizes == size), index[int(size)]
                leaf[at] = tree.of(tree.projection.candidates(matrix(batch.column("vector").take(pa.array(at)))))
            arrays = [pa.array(sizes, pa.int32()), pa.array(leaf), *(batch.column(c) for c in ("row", "vec_id", "vector"))]
            yield pa.record_batch(arrays, names=["size", "leaf", "row", "vec_id", "vector"])

    return run


_CANDIDATE = "size int, leaf long, row long, vec_id long, vector array<double>"
_VISIT = "size int, leaf long, part int, row long, vec_id long, vector array<double>, floor double"


def _grown(rows: DataFrame, index: dict[int, Tree], block: int) -> DataFrame:
    """Cut crowded leaves again until none is left; the rows with their leaves."""
    while True:
        placed = staged(rows.mapInArrow(_candidate_leaves(index), _CANDIDATE), "leaves")
        crowded = placed.groupBy("size", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > block)
        crowded = [r for r in crowded.collect() if r["leaf"] not in index[r["size"]].parts]  # a row for each crowded leaf
        if not crowded:
            return placed
        kind = "size int, leaf long, n long"
        wanted = rows.sparkSession.createDataFrame([tuple(r) for r in crowded], kind)
        rate = F.lit(float(SAMPLE)) / F.col("n") * (1 << 30)
        drawn = placed.join(wanted, ["size", "leaf"]).where(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(1 << 30)) < rate)

        def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            y = index[int(key[0])].projection.candidates(np.stack(pdf["vector"].to_numpy()))
            cells = Cells(y, max(2, cell_count(int(pdf["n"].iloc[0]), block)))
            most = np.bincount(cells.of(y)).max() / len(y)
            return pd.DataFrame({"size": [key[0]], "leaf": [key[1]], "axis": [cells.axis.tolist()], "at": [cells.at.tolist()], "most": [most]})

        fitted = drawn.groupBy("size", "leaf").applyInPandas(fit, "size int, leaf long, axis array<int>, at array<double>, most double")
        found = {(r["size"], r["leaf"]): r for r in fitted.collect()}  # ``CELLS`` numbers for each crowded leaf
        for r in crowded:
            tree, cut = index[r["size"]], found.get((r["size"], r["leaf"]))
            if cut is None or cut["most"] > 0.9:  # points that no cut parts
                tree.parts[r["leaf"]] = -(-r["n"] // block)
            else:
                tree.cells[r["leaf"]] = Cells.of_cuts(np.array(cut["axis"]), np.array(cut["at"]), DIMENSIONS)
        for tree in index.values():
            tree.seal()


def nearest(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", most: int = NEAREST, every: int = EVERY, sure: float = SURE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest found of every query."""
    rows = rows_of(df, vec_id, embedding).where("node is not null and vec_id is not null").withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.max(norm).alias("largest"), F.count("*").alias("n")).collect()
    sample = rows.orderBy(F.xxhash64("node", F.lit(1)), "node", "row").limit(SAMPLE).select("vector").toPandas()["vector"]  # SAMPLE rows at most
    index = {}
    for r in lengths:
        projection, part = Projection(r["size"], r["largest"]), [v for v in sample if len(v) == r["size"]]
        y = projection.candidates(np.stack(part)) if part else np.zeros((0, DIMENSIONS))
        index[r["size"]] = Tree(projection, Cells(y, cell_count(r["n"], block)))
    stretch = chi_square_quantile(sure, DIMENSIONS)
    placed = _grown(rows.select("row", "vec_id", "vector"), index, block)
    parts = [(size, leaf, n) for size, tree in index.items() for leaf, n in tree.parts.items()]
    split = df.sparkSession.createDataFrame(parts, "size int, leaf long, parts int")
    part = F.pmod(F.xxhash64("row", F.lit(2)), F.coalesce("parts", F.lit(1))).cast("int")
    candidates = placed.join(split, ["size", "leaf"], "left").withColumn("part", part).drop("parts")
    queries = rows.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vector")
    keys = ["size", "leaf", "part", "turn"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            size = int(left["size"].iloc[0])
            own = Block(np.stack(left["vector"].to_numpy()), left["vec_id"].to_numpy(), left["row"].to_numpy(), index[size].projection)
            for row, query_id, vector, floor in zip(right["row"], right["vec_id"], right["vector"], right["floor"], strict=True):
                ids, products = own.search(np.asarray(vector), row, -np.inf if np.isnan(floor) else floor, most, stretch)
                found.append(pd.DataFrame({"row": row, "query_id": query_id, "vec_id": ids, "score": products}))
        return pd.concat(found) if found else pd.DataFrame({c: [] for c in ("row", "query_id", "vec_id", "score")})

    def searched(asked: DataFrame) -> DataFrame:
        visits = staged(asked.mapInArrow(_visits(index, stretch), _VISIT), "visits")
        turns = visits.groupBy("size", "leaf", "part").agg(F.ceil(F.count("*") / block).cast("int").alias("turns"))
        turns = staged(turns, "turns")  # a row for each block that is visited
        turn = F.pmod(F.xxhash64("row", F.lit(5)), F.col("turns")).cast("int")
        right = visits.join(turns, keys[:3]).withColumn("turn", turn).drop("turns")
        left = candidates.join(turns, keys[:3]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(search, "row long, query_id long, vec_id long, score double")

    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    first = staged(best(searched(queries.withColumn("floor", F.lit(None).cast("double")))), "first-found")
    floors = first.where(F.col("rank") == most).select("row", F.col("score").alias("floor"))
    again = queries.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    found = first.drop("rank").unionByName(searched(again))
    return best(found).select("query_id", "rank", "vec_id", "score")
