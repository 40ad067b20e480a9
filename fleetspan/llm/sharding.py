"""Shards of equal bytes by a k-d tree over what is known of a text.

A node is split at the weighted median of its widest dimension (log of the
size, characters a byte, checksum, each as a share of its range over all rows)
until there are as many leaves as shards; a node with an odd number of leaves
is split in proportion. Weights are bytes.

The median is found without a sort: sums by the first bits of the coordinate,
combined before they are shuffled, tell in which range it lies, and only that
range is looked at more closely. What comes to the driver is one cut for each
node, so its size depends on the number of shards only.

All coordinates follow from the text, so equal texts share a shard. Only a group
of equal texts that holds more than a hundredth of a shard's bytes may be cut,
by a hash of the ids: else shards could not be near equal when one text holds a
third of all rows.

A null text has no bytes and the checksum of an empty one. Repeated rows are rows
of their own, with slots of their own. An empty table gives an empty result.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.plans.shared import staged

SHARDS = 8
BUCKETS = 512
"""Parts in which the rows of a shard are numbered."""
BITS = 20
STEPS = (42, 32, 21, 10, 0)
"""Bits of a place (``BITS`` of the coordinate, 32 of the checksum) that are left out, step by step: 2,048 ranges of a node at most."""
DIMENSIONS = ("wide", "ratio", "check")


@dataclass
class _Node:
    leaves: int
    first: int
    where: Column


def _measured(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    crc = F.crc32(body.cast("binary"))
    return df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.log2(size).alias("wide"),
        (F.char_length(body) / size).alias("ratio"),
        (crc / float(1 << 32)).alias("check"),
    )


def _crossing(rows: DataFrame, place: Column, wanted: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """For each node the place where its running weight passes what is wanted: (place, weight before, weight there)."""
    sums = rows.groupBy("node", place.alias("place")).agg(F.sum("size").alias("there"))
    running = Window.partitionBy("node").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("there").over(running), F.lit(0)))
    amount = F.element_at(F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair]), F.col("node"))
    hit = sums.where((F.col("before") < amount) & (F.col("before") + F.col("there") >= amount))
    return {r["node"]: (r["place"], r["before"], r["there"]) for r in hit.collect()}


def _splits(rows: DataFrame, nodes: list[_Node], spread: dict[str, tuple[float, float]], light: float) -> list[_Node]:
    """Split every node that holds more than one leaf."""
    several = {i: n for i, n in enumerate(nodes) if n.leaves > 1}
    number = F.lit(None).cast("int")
    for i, node in several.items():
        number = F.when(node.where, i).otherwise(number)
    rows = rows.withColumn("node", number).where(F.col("node").isNotNull())
    aggregates = [f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]
    stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *aggregates).collect()}
    share = lambda d: (F.col(d) - spread[d][0]) / (spread[d][1] or 1.0)
    coordinate, wanted, half = F.lit(0.0), {}, {}
    for i, node in several.items():
        half[i] = node.leaves // 2
        if (r := stats.get(i)) is None:
            continue
        widest = max(DIMENSIONS, key=lambda d: (r[f"{d}_max"] - r[f"{d}_min"]) / (spread[d][1] or 1.0))
        coordinate = F.when(F.col("node") == i, share(widest)).otherwise(coordinate)
        wanted[i] = max(1, round(r["bytes"] * half[i] / node.leaves))
    rows = rows.withColumn("place", F.floor(coordinate * (1 << BITS)).cast("long") * (1 << 32) + F.col("text_crc32"))
    cuts = {i: (0, 0, 0) for i in wanted}
    for last, shift in zip((None, *STEPS), STEPS, strict=False) if wanted else ():
        inside, rest = F.lit(False), {}
        for i, (place, before, _) in cuts.items():
            rest[i] = wanted[i] - before
            inside = inside | ((F.col("node") == i) & (F.lit(True) if last is None else F.shiftright("place", last) == place))
        found = _crossing(rows.where(inside), F.shiftright("place", shift), rest)
        cuts = {i: (place, cuts[i][1] + before, there) for i, (place, before, there) in found.items()}
    split = []
    for i, node in enumerate(nodes):
        if i not in several:
            split.append(node)
            continue
        place, before, there = cuts.get(i, (0, 0, 0))
        part = (wanted[i] - before) / there if there else 0.0
        part = part if there > light else float(round(part))
        widest = F.lit(0.0)
        if (r := stats.get(i)) is not None:
            widest = share(max(DIMENSIONS, key=lambda d: (r[f"{d}_max"] - r[f"{d}_min"]) / (spread[d][1] or 1.0)))
        at = F.floor(widest * (1 << BITS)).cast("long") * (1 << 32) + F.col("text_crc32")
        by_id = F.pmod(F.xxhash64(F.lit(node.first), F.lit(node.leaves), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
        left = (at < place) | ((at == place) & (by_id < part))
        split.append(_Node(half[i], node.first, node.where & left))
        split.append(_Node(node.leaves - half[i], node.first + half[i], node.where & ~left))
    return split


def balanced_shards(df: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is bytes) of every row."""
    rows = staged(_measured(df, doc_id, text), "sizes")
    whole = rows.agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]).first()
    nodes = [_Node(shards, 0, F.lit(True))]
    if whole["bytes"]:
        spread = {d: (whole[f"{d}_min"], whole[f"{d}_max"] - whole[f"{d}_min"]) for d in DIMENSIONS}
        while any(n.leaves > 1 for n in nodes):
            nodes = _splits(rows, nodes, spread, whole["bytes"] / shards / 100)
    shard = F.lit(0)
    for node in nodes:
        shard = F.when(node.where, node.first).otherwise(shard)
    placed = staged(rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard")), "placed")
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(BUCKETS)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    running = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(inside)).join(counts, ["shard", "bucket"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
