"""Window features over each engine's history.

An engine is normally a few hundred rows, and one window partition per engine
is right. ``over_history`` also copes with an engine that holds a large share of
the table: its history is cut into blocks of the order column, every block gets
the last ``back`` rows before it as context, and blocks become the window
partitions. The result is the same row for row, gaps included.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fleetspan import constants as C

BLOCK_CYCLES = 1_000_000

Features = Callable[[WindowSpec], dict[str, Column]]


def over_history(
    df: DataFrame,
    features: Features,
    back: int,
    keys: list[str] = C.KEYS,
    order: str = "cycle",
    rows_per_key: int | None = None,
    block: Column | None = None,
    block_rows: int = BLOCK_CYCLES,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows behind the current one.

    ``features`` maps an ordered window to the new columns. ``rows_per_key`` is
    a proven bound on the rows of one key; without one, key counts are checked
    first. ``block`` is a non-decreasing function of ``order`` that holds few
    rows per value (default: ``block_rows`` cycles).
    """
    if rows_per_key is None:
        rows_per_key = _largest_key_over(df, keys, block_rows)
    if rows_per_key <= block_rows:
        return df.withColumns(features(Window.partitionBy(*keys).orderBy(order)))
    if block is None:
        block = F.floor(F.col(order) / block_rows)
    return _blocked(df, features, back, keys, order, block)


def _largest_key_over(df: DataFrame, keys: list[str], limit: int) -> int:
    """0 when no key has more than ``limit`` rows; map-side counts, key columns only."""
    over = df.groupBy(*keys).count().where(F.col("count") > limit)
    return 0 if over.isEmpty() else limit + 1


def _blocked(
    df: DataFrame, features: Features, back: int, keys: list[str], order: str, block: Column
) -> DataFrame:
    data = df.withColumn("_block", block.cast("long"))
    context = _context_rows(data, back, keys, order)
    both = data.withColumn("_own", F.lit(True)).unionByName(context.withColumn("_own", F.lit(False)))
    window = Window.partitionBy(*keys, "_block").orderBy(order)
    return both.withColumns(features(window)).where("_own").drop("_own", "_block")


def _context_rows(data: DataFrame, back: int, keys: list[str], order: str) -> DataFrame:
    """The last ``back`` rows before each block, tagged with that block."""
    payload = [c for c in data.columns if c not in keys and c not in (order, "_block")]
    newest_first = Window.partitionBy(*keys, "_block").orderBy(F.col(order).desc())
    tails = (
        data.withColumn("_nth", F.row_number().over(newest_first))
        .where(F.col("_nth") <= back)
        .groupBy(*keys, "_block")
        .agg(F.array_sort(F.collect_list(F.struct(order, *payload))).alias("_tail"))
    )
    # Every block holds a row, so ``back`` earlier blocks always reach far enough.
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(-back, -1)
    earlier = F.flatten(F.collect_list("_tail").over(before))
    return (
        tails.withColumn("_earlier", earlier)
        .where(F.size("_earlier") > 0)
        .withColumn("_row", F.explode(F.slice("_earlier", -F.least(F.lit(back), F.size("_earlier")), back)))
        .select(*keys, "_row.*", "_block")
        .select(*data.columns)
    )


def rolling(
    df: DataFrame,
    sensors: list[str] | tuple[str, ...] = C.KEY_SENSORS,
    rows: int = C.ROLLING_ROWS,
    mean: bool = True,
    std: bool = True,
    **history,
) -> DataFrame:
    """Mean and sample deviation of the last ``rows`` readings; deviation starts at 0."""

    def features(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(1 - rows, 0)
        out = {}
        if mean:
            out |= {f"{s}_rolling_avg": F.avg(s).over(frame) for s in sensors}
        if std:
            out |= {
                f"{s}_rolling_std": F.coalesce(F.stddev_samp(s).over(frame), F.lit(0.0))
                for s in sensors
            }
        return out

    return over_history(df, features, back=rows - 1, **history)


def cycle_delta(df: DataFrame, sensor: str = "sensor_2", **history) -> DataFrame:
    """Previous reading of a sensor and the change since, null on an engine's first row."""
    previous, change = f"previous_cycle_{sensor}", "change_from_last_cycle"
    out = over_history(
        df.select("engine_id", "dataset", "cycle", sensor),
        lambda window: {previous: F.lag(sensor).over(window)},
        back=1,
        **history,
    )
    return out.withColumn(change, F.round(F.col(sensor) - F.col(previous), 4))
