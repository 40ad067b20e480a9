"""Reading feeds and running micro-batch queries to a table.

Result tables are folders of per-batch files. A batch that is run again after a
failure overwrites its own folder, so every sink here is idempotent.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.plans.binding import as_feed

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_feed(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet event table, one file or a folder of files, as a stream of (engine_id, ts, rul).

    A stream's path must be a folder or a pattern; a pattern that only the path
    itself matches stands for both.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return as_feed(reader.parquet(f"{path[:-1]}[{path[-1]}]"))


def in_time_order(events: DataFrame, path: str, batches: int, files: int) -> None:
    """An event table as files in time order: ``batches`` times ``files`` of them, written one slice after another."""
    cuts = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [i / batches for i in range(1, batches)], 1000)).first()[0]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    edges = [None, *sorted(set(cuts or [])), None]
    for low, high in zip(edges, edges[1:], strict=False):
        inside = F.lit(True) if low is None else at >= low
        inside = inside if high is None else inside & (at < high)
        events.where(inside).repartition(files).write.mode("append").parquet(path)


def run_available(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    reread: bool = False,
) -> None:
    """Process everything available, batch by batch, and stop.

    ``reread`` keeps a batch cached while it is worked on, for steps that scan it
    more than once.
    """

    def cached(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            each_batch(batch, batch_id)
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(cached if reread else each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def newest_version(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Each key's row from the last batch that changed it."""
    changes = spark.read.parquet(path)
    rest = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in rest])
