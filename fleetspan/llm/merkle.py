"""Merkle manifest of a dataset: a hash tree a group (language), and one over the groups.

A leaf is the SHA-256 of a row's columns, each as byte count and value. Leaves of a
group stand in the order of doc_id; every level joins its nodes with their siblings
on the computed index (``i XOR 1``), and the nodes with even index emit the parents
(a last node without a sibling is hashed alone) until one is left. Roots of groups,
in the order of the groups, form the top tree in the same way.

Proofs come down the same tables: a node's path is its own sibling followed by its
parent's path, so every level is one equijoin and rows halve from level to level. A
path has 33 bytes a level: the side of the sibling and its digest.

Places are numbered without a sort in one task: rows are dealt out by range of (group,
order), sorted and numbered in each part, and parts are put behind one another by
their counts. One group may hold all rows. Levels are written tables.

Null values are written ``-``; a null doc_id comes first and is never altered; a null
group comes first. Rows with one doc_id stand in the order of their leaves, so repeated
rows are leaves of their own whose proofs may differ, and the result is the same as
a set of rows on every run. Text of any length is hashed whole. Other columns, clashing
names included, are not looked at. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.plans.shared import staged

ALTERED_EVERY = 7
"""Rows whose doc_id has a CRC-32 divisible by this are altered in the test of the manifest."""
_LEFT, _RIGHT, _ALONE = "4C", "52", "2D"
_STEP = 33


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts put together, as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as byte count, colon and text; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(df: DataFrame, columns: dict[str, str], group: str, alter: str) -> DataFrame:
    """doc_id, g (the group as a sort key, null first), hash of every row, and altered: the hash
    with one added to the column ``alter``, on the rows that are tampered with.

    columns: the hashed columns in order, each with its type; the first is the order of the leaves.
    """
    values = {name: F.col(name).cast(kind) for name, kind in columns.items()}
    first = next(iter(values.values()))
    changed = values | {alter: values[alter].cast("decimal(20,0)") + 1}
    hit = F.coalesce(F.crc32(first.cast("string").cast("binary")) % ALTERED_EVERY == 0, F.lit(False))
    return df.select(
        first.alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
        digest(*map(field, values.values())).alias("hash"),
        F.when(hit, digest(*map(field, changed.values()))).alias("altered"),
    )


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their place i in the group g (from 0) and the group's size n; and (g, n)."""
    placed = df.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    placed = placed.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    placed = staged(placed, "merkle-places")
    parts = placed.groupBy("g", "part").agg(F.min("at").alias("start"), F.count("*").alias("there"))
    # A row for each part that a group reaches into.
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"ahead": F.coalesce(F.sum("there").over(before), F.lit(0)), "n": F.sum("there").over(Window.partitionBy("g"))})
    parts = staged(parts.select("g", "part", (F.col("ahead") - F.col("start")).alias("shift"), "n"), "merkle-parts")
    rows = placed.join(parts, ["g", "part"]).withColumn("i", F.col("at") + F.col("shift"))
    return rows.select("g", "i", "n", *[c for c in df.columns if c != "g"]), parts.select("g", "n").distinct()


def _beside(nodes: DataFrame) -> DataFrame:
    """Nodes with the hash of their sibling, null where there is none."""
    sibling = nodes.where("n > 1").select("g", F.col("i").bitwiseXOR(F.lit(1)).alias("i"), F.col("hash").alias("sibling"))
    return nodes.join(sibling, ["g", "i"], "left")


def _parents(level: DataFrame) -> DataFrame:
    joined = digest(F.col("hash"), F.coalesce("sibling", F.lit("")))
    return level.where("n > 1 AND i % 2 = 0").select("g", F.expr("i div 2").alias("i"), F.expr("(n + 1) div 2").alias("n"), joined.alias("hash"))


def build(nodes: DataFrame, most: int) -> list[DataFrame]:
    """All levels from the leaves up (g, i, n, hash, sibling and what the leaves bring); ``most``: leaves of the largest group."""
    levels = []
    while True:
        levels.append(staged(_beside(nodes), "merkle-level"))
        if most <= 1:
            return levels
        nodes, most = _parents(levels[-1]), (most + 1) // 2


def roots(levels: list[DataFrame]) -> DataFrame:
    """(g, hash, depth) of every group's last node."""
    found = [level.where("n = 1").select("g", "hash", F.lit(k).alias("depth")) for k, level in enumerate(levels)]
    union = found[0]
    for more in found[1:]:
        union = union.union(more)
    return staged(union, "merkle-roots")


def _entry() -> Column:
    """One level of a path: the sibling's side and digest."""
    side = F.when(F.col("i") % 2 == 1, F.expr(f"X'{_LEFT}'")).otherwise(F.expr(f"X'{_RIGHT}'"))
    alone = F.expr(f"X'{_ALONE}{'00' * (_STEP - 1)}'")
    return F.when(F.col("sibling").isNull(), alone).otherwise(F.concat(side, F.unhex("sibling")))


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with ``path``, their siblings up to the top; tops: (g, depth, path) of the groups' roots."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        ends = level.where("n = 1").drop("sibling").join(tops.where(F.col("depth") == k).select("g", "path"), "g")
        rows = ends
        if above is not None:
            parent = above.select("g", F.col("i").alias("up"), F.col("path").alias("rest"))
            inner = level.where("n > 1").withColumn("up", F.expr("i div 2")).join(parent, ["g", "up"])
            inner = inner.withColumn("path", F.concat(_entry(), F.col("rest"))).drop("up", "rest", "sibling")
            rows = inner.unionByName(ends)
        above = staged(rows, "merkle-paths") if k else rows
    return above


def _steps() -> Column:
    """Positions of a path's levels; none in an empty path."""
    count = F.expr(f"length(path) div {_STEP}")
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _side(k: Column) -> Column:
    return F.hex(F.substring(F.col("path"), k * _STEP + 1, 1))


def _sibling(k: Column) -> Column:
    return F.lower(F.hex(F.substring(F.col("path"), k * _STEP + 2, _STEP - 1)))


def proof_text() -> Column:
    """The siblings of a path as hex, from the leaf upwards."""
    return F.array_join(F.transform(_steps(), lambda k: F.when(_side(k) != _ALONE, _sibling(k)).otherwise(F.lit(""))), "")


def folded(leaf: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(hash_: Column, k: Column) -> Column:
        side = _side(k)
        return F.when(side == _LEFT, digest(_sibling(k), hash_)).when(side == _RIGHT, digest(hash_, _sibling(k))).otherwise(digest(hash_))

    return F.aggregate(_steps(), leaf, up)


def manifest(
    df: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
    text: str = "text",
) -> DataFrame:
    """doc_id, leaf, altered, subroot, root and path (binary, see above) of every row."""
    columns = {doc_id: "long", source: "string", lang: "string", n_chars: "long", text: "string"}
    rows, groups = numbered(leaves(df, columns, lang, n_chars), ["doc_id", "hash"])
    levels = build(rows, groups.agg(F.max("n")).first()[0] or 0)
    subroots = roots(levels)
    ranked, whole = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "hash", "depth"), ["lang"])
    top = build(ranked, whole.agg(F.max("n")).first()[0] or 0)
    summit = roots(top)
    root = summit.select("hash").first()
    start = summit.select("g", "depth", F.expr("X''").alias("path"))
    tops = staged(paths(top, start).select(F.col("lang").alias("g"), F.col("hash").alias("subroot"), "depth", "path"), "merkle-tops")
    found = paths(levels, tops).join(tops.select("g", "subroot"), "g")
    return found.select("doc_id", F.col("hash").alias("leaf"), "altered", "subroot", F.lit(root and root[0]).cast("string").alias("root"), "path")


def manifest_check(df: DataFrame, **columns: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the altered leaf where there is one) and verified."""
    back = folded(F.coalesce("altered", "leaf"))
    rows = manifest(df, **columns).select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(), 256).alias("proof_sha256"), back.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
