"""Operators on vectors against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from fleetspan.llm import forest_dedup, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, node string, vector int"


def clusters(n: int, size: int = 32, seed: int = 3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 5, size))
    rows = [(i, [float(np.float32(v)) for v in centres[i % len(centres)] + rng.normal(size=size) * (0.25 if i % 3 else 0.9)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(30)]
    odd = [(n + 50, None), (n + 51, [0.0] * size), (n + 52, [math.nan] * size), (n + 53, [math.inf] + [1.0] * (size - 1)), (n + 54, [None] + [1.0] * (size - 1)), (n + 55, [1.0, 2.0]), (n + 56, []), (n + 57, [2.0, 4.0]), (n + 57, [2.0, 4.0]), (None, rows[3][1])]
    return [(i, v, 1, "x", 2) for i, v in [*rows, *odd]]


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(clusters(900), SCHEMA)


def truth(rows, cosine=0.9):
    n = len(rows)
    near = np.zeros((n, n), bool)
    for size in {len(v) for _, v in rows if good(v)}:
        at = [i for i, (_, v) in enumerate(rows) if good(v) and len(v) == size]
        x = np.array([rows[i][1] for i in at], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(at, at)] = x @ x.T >= cosine - 1e-12
    np.fill_diagonal(near, False)
    part = np.arange(n)
    while True:
        new = np.array([min(part[i], part[near[i]].min(initial=n)) for i in range(n)])
        if (new == part).all():
            return near, part
        part = new


@pytest.mark.parametrize("cell", [8192, 200])
def test_forest(spark, vectors, cell):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    near, part = truth(rows)
    got = forest_dedup.near_vectors(vectors, cell=cell).collect()
    assert Counter(r["vec_id"] for r in got) == Counter(i for i, _ in rows)
    assert sum(r["n_links"] for r in got) >= 0.95 * near.sum()
    want = Counter((i, int(k)) for (i, _), k in zip(rows, near.sum(1), strict=True))
    assert all(r["n_links"] <= max(k for i, k in want if i == r["vec_id"]) for r in got)
    low = {}
    for (i, _), p in zip(rows, part, strict=True):
        if i is not None:
            low[p] = min(low.get(p, i), i)
    wanted = Counter((i, low.get(p)) for (i, _), p in zip(rows, part, strict=True))
    found = Counter((r["vec_id"], r["component_id"]) for r in got)
    assert (wanted & found).total() >= 0.95 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_neighbours(spark, vectors):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = {}
    for r in neighbours.nearest(vectors, block=300).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for i, v in rows:
        if i is None or i % 20 or not good(v):
            continue
        best = sorted((-float(np.dot(np.array(v, float), np.array(w, float))), j) for j, w in rows if j is not None and j != i and good(w) and len(w) == len(v))[:20]
        found = sorted(got.pop(i))
        assert [f[0] for f in found] == list(range(1, len(best) + 1))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hit += len({j for _, j in best} & {f[1] for f in found})
        total += len(best)
    assert not got and hit >= 0.9 * total


def test_crowded_cells_are_cut_again(spark):
    """Blocks stay small under a hot group of equal vectors and many rows; no candidate is lost."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(2500, 16)), np.tile(rng.normal(size=16), (1200, 1))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, block=100).collect()
    products = x.astype(float) @ x.astype(float).T
    hit = total = 0
    for q in range(0, len(x), 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        row = products[q].copy()
        row[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -row))[:20]
        assert [m[0] for m in mine] == list(range(1, 21)) and all(m[2] == pytest.approx(row[m[1]]) for m in mine)
        hit += len({m[1] for m in mine} & set(best.tolist()))
        total += 20
    assert hit >= 0.95 * total
    index = {16: neighbours.Tree(neighbours.Projection(16, 10.0), neighbours.Cells(np.zeros((0, 10)), 1))}
    placed = neighbours._grown(df.selectExpr("vec_id AS row", "vec_id", "cast(embedding AS array<double>) AS vector"), index, 100)
    counts = placed.groupBy("leaf").count().collect()
    assert sum(r["count"] for r in counts) == len(x)
    assert all(r["count"] <= 100 * index[16].parts.get(r["leaf"], 1) for r in counts) and len(index[16].parts) == 1


def test_recall_on_the_test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(df).collect()}
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        product = x @ x[q]
        product[q] = -np.inf
        for j in np.lexsort((ids, -product))[:20]:
            hit += (ids[q], ids[j]) in got
            total += 1
    assert hit >= 0.9 * total


def links_of(x, cosine=0.9):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(unit[a : a + 1000] @ unit.T >= cosine).sum(1) - 1 for a in range(0, len(unit), 1000)])


def found_links(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    return {r["vec_id"]: r for r in forest_dedup.near_vectors(df).collect()}


def test_multiples_of_one_vector(spark):
    """Nothing parts vectors that differ in length only; all of them are linked."""
    rng = np.random.default_rng(4)
    line = rng.normal(size=64)
    x = np.concatenate([line * (1 + 0.001 * np.arange(6000))[:, None], line * 2.0 ** np.arange(60)[:, None] * 1e-6, rng.normal(size=(500, 64))]).astype(np.float32)
    got = found_links(spark, x)
    want = links_of(x.astype(float))
    assert want[0] == 6059 and [got[i]["n_links"] for i in range(len(x))] == want.tolist()
    assert {got[i]["component_id"] for i in range(6060)} == {0}


def test_cutting_ends_where_nothing_is_parted():
    line = np.random.default_rng(5).normal(size=32)
    for x in (np.tile(line, (3000, 1)), line * (1 + 0.001 * np.arange(3000))[:, None], np.sign(np.random.default_rng(6).normal(size=(3000, 1)))):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        assert len(forest_dedup.fit_top(x, 0, 1)) < 100
        assert len(forest_dedup.leaf_pairs(x, 0, 1, 0.9)[1]) == len(x)


def test_recall_by_size_of_planted_clusters(spark):
    rng = np.random.default_rng(9)
    sizes = [10] * 100 + [100] * 20 + [500] * 4 + [5000]
    parts = [rng.normal(size=64) + rng.normal(size=(n, 64)) * 0.22 for n in sizes]
    x = np.concatenate([*parts, rng.normal(size=(20_000, 64))]).astype(np.float32)
    want, got = links_of(x.astype(float)), found_links(spark, x)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= want).all()
    of = np.concatenate([np.repeat(sizes, sizes), np.zeros(20_000, int)])
    recall = {n: found[of == n].sum() / want[of == n].sum() for n in (10, 100, 500, 5000)}
    print(recall)
    assert want[of == 5000].mean() > 2500 and min(recall.values()) >= 0.95


def test_forest_in_a_group_of_near_vectors(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    spread = rng.normal(size=(12000, 64)) * np.where(np.arange(12000) < 11000, 0.3, 0.6)[:, None]
    x = np.concatenate([centre + spread, rng.normal(size=(2000, 64))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(len(x) + i, x[5].tolist()) for i in range(3)]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = np.concatenate([(unit[a : a + 1000] @ unit.T >= 0.9).sum(1) - 1 for a in range(0, len(unit), 1000)])
    assert near.max() > 10000
    got = {r["vec_id"]: r for r in forest_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert len(got) == len(rows)
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= near).all() and found.sum() >= 0.999 * near.sum()
    crowd = near > 1000
    assert (found[crowd] == near[crowd]).all() and len({got[i]["component_id"] for i in np.flatnonzero(crowd)}) == 1


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert forest_dedup.near_vectors(nothing).count() == 0
    assert neighbours.nearest(nothing).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square_quantile(0.95, 10) - 18.307) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.5, 2) - 1.38629) < 1e-4
