"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target of words. Whole epochs of it are taken while they fit;
what is left is a weighted sample without replacement: every document has the
key -ln(u) / weight, u from a hash of its id, and documents are taken in the
order of their keys until the words are used up (the last one in part).

A source is not sorted in one task. Keys fall into ranges; sums over source and
range, combined before they are shuffled, tell in which range the budget ends.
That range is cut again, between its smallest and its largest key, until it has
``FEW`` rows at most or only equal keys. Documents of earlier ranges are taken,
those of later ones are not, and only that last range of each source is sorted.

Null and empty texts have size 0 and are never a reason to stop. A null source
is a source of its own, the last. Repeated rows are documents of their own; equal
keys are ordered by id and size, and rows that are equal in these get equal parts
in any order. An empty table gives an empty result. Other columns don't matter.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.llm.words import fresh, row_key
from fleetspan.plans.shared import staged

WEIGHTS = (5, 2, 1)
"""Of the sources in code point order, repeating."""
EPOCHS = 3
RANGES = 4096
FEW = 1000
"""Rows of a range that is not cut again."""
WORD = r"[^\x20\x09-\x0D]+"


def quality_weight(text: Column) -> Column:
    """Share of a text's bytes that aren't blanks, punctuation or digits, from 0.1 to 1."""
    letters = F.octet_length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    return F.greatest(F.lit(0.1), F.coalesce(letters / F.greatest(F.octet_length(text), F.lit(1)), F.lit(0.0)))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the id alone."""
    head = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("double")
    return (head + 0.5) / float(1 << 48)


def measured(df: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """What the sampling needs of each document: row, doc_id, source, size, key."""
    body = F.col(text).cast("string")
    size = F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long")
    key = -F.log(uniform(F.col(doc_id))) / quality_weight(body)
    return df.select(row_key(doc_id, text).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"), key.alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Add each source's target: its share by weight, ``epochs`` times its size at most, the excess shared again.

    ``sizes`` has one row for each source (source, source_size). With sources in
    the order of what they can give for a unit of weight, a source is full if
    the share a unit would get, once all before it are full, is no less than that.
    """
    by_code = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    number = (F.row_number().over(by_code) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (number + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("most", F.lit(float(epochs)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ranked = ranked.withColumn("unit", left / F.sum("weight").over(after))
    ranked = ranked.withColumn("full", F.col("unit") * F.col("weight") >= F.col("most"))
    ranked = ranked.withColumn("level", F.first(F.when(~F.col("full"), F.col("unit")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return ranked.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.col("level") * F.col("weight"))).select("source", "source_size", "target")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _sums() -> list[Column]:
    return [F.sum("size").alias("size"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")]


def _ending(sums: DataFrame, by: list[str]) -> DataFrame:
    """Of the ranges of each source (of, range, size, n, low, high, rest, start), the one in which its rest ends, with the words before it."""
    running = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(running), F.lit(0)))
    return sums.where("before <= rest and rest < before + size").select(*by)


def _last_ranges(rows: DataFrame, sums: DataFrame, plan: DataFrame) -> DataFrame:
    """of, low and high (keys), before and n of the range in which each source's rest ends, cut until few rows are left."""
    columns = ["of", "rest", "low", "high", "before", "n"]
    start = sums.join(plan.select("of", "rest"), _same("source", "of")).withColumn("start", F.lit(0).cast("long"))
    last = staged(_ending(start, columns), "last-ranges")
    large = F.coalesce((F.col("n") > FEW) & (F.col("low") < F.col("high")), F.lit(False))
    while not last.where(large).isEmpty():
        wide = last.where(large).select("of", "rest", "before", F.col("low").alias("least"), F.col("high").alias("most"))
        inside = rows.join(wide, _same("source", "of") & F.col("key").between(F.col("least"), F.col("most")))
        place = (F.col("key") - F.col("least")) / (F.col("most") - F.col("least"))
        finer = inside.withColumn("range", F.least(F.floor(place * RANGES), F.lit(RANGES - 1)))
        finer = finer.groupBy("of", "rest", F.col("before").alias("start"), "range").agg(*_sums())
        last = staged(last.where(~large).unionByName(_ending(finer, columns)), "last-ranges")
    return last


def _planned(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """rows (row, doc_id, source, size, key) with source_size, target and taken."""
    ranged = rows.withColumn("range", F.floor((1 - F.exp(-F.least(F.col("key"), F.lit(60.0)))) * RANGES).cast("int"))
    sums = staged(ranged.groupBy("source", "range").agg(*_sums()), "ranges")
    plan = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    budget = F.floor("target").cast("long")
    turns = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("turns", turns).withColumn("rest", budget - F.col("turns") * F.col("source_size"))
    plan = staged(plan.withColumnRenamed("source", "of"), "targets")
    last = _last_ranges(rows, sums, plan).select(F.col("of").alias("last_of"), "low", "high", "before")
    plan = staged(plan.join(last, _same("of", "last_of"), "left").drop("last_of"), "plan")  # a table of its own, so its size is known
    placed = rows.join(plan, _same("source", "of")).drop("of")
    in_last = F.col("key").between(F.col("low"), F.col("high")) & (F.col("rest") > F.col("before"))
    early = placed.where(~F.coalesce(in_last, F.lit(False)))
    early = early.withColumn("part", F.when((F.col("key") < F.col("low")) & (F.col("rest") > 0), F.col("size")).otherwise(0))
    ordered = Window.partitionBy("source").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    late = placed.where(in_last)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(ordered), F.lit(0))
    late = late.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    taken = F.col("turns") * F.col("size") + F.col("part")
    return early.unionByName(late).withColumn("taken", taken.cast("long"))


def mixed_sources(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row."""
    rows = staged(measured(df, doc_id, text, source), "sizes")
    return _planned(rows, weights, epochs).select("doc_id", "size", "source_size", "target", "taken")


def mixture(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, whole: bool = False) -> DataFrame:
    """The documents the mix takes, each as often as it is taken; those of size 0 once.

    One taken in part has its first words, joined by a blank; with ``whole`` it is taken whole
    if at least half of it is due, else not at all, so a source ends as near to its target as it can.
    """
    rows = staged(measured(df, doc_id, text, source), "sizes")
    plan = _planned(rows, weights, epochs).where("taken > 0 or size = 0")
    key, full, rest, copy = (fresh(df, c) for c in ("row_key", "mix_full", "mix_rest", "mix_copy"))
    size, over = F.greatest("size", F.lit(1)), F.when(F.col("size") > 0, F.col("taken") % F.greatest("size", F.lit(1))).otherwise(0)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / size)).otherwise(1)
    if whole:
        times, over = times + F.when((over > 0) & (2 * over >= F.col("size")), 1).otherwise(0), F.lit(0)
    plan = plan.select("row", times.alias(full), F.when(over > 0, over).cast("int").alias(rest))
    plan = plan.groupBy(F.col("row").alias(key)).agg(F.sum(full).cast("int").alias(full), F.sort_array(F.collect_list(rest)).alias(rest))
    docs = df.withColumn(key, row_key(doc_id, text)).dropDuplicates([key]).join(plan, key)
    parts = F.concat(F.array_repeat(F.lit(0), F.col(full)), rest)
    docs = docs.withColumn(copy, F.explode(parts))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1), 1, F.col(copy)), " ")
    return docs.withColumn(text, F.when(F.col(copy) > 0, head).otherwise(F.col(text))).select(*df.columns)
