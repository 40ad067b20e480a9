"""Status, life-bucket and action rules as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetspan import constants as C


def health_status(
    rul: Column,
    good: str = "NORMAL",
    null_label: str | None = None,
    danger_below: int = C.DANGER_BELOW,
    warning_below: int = C.WARNING_BELOW,
) -> Column:
    """DANGER, WARNING or ``good``; a null life gets ``null_label`` (default ``good``)."""
    return (
        F.when(rul.isNull(), F.lit(null_label or good))
        .when(rul < danger_below, F.lit("DANGER"))
        .when(rul < warning_below, F.lit("WARNING"))
        .otherwise(F.lit(good))
    )


def is_danger(rul: Column) -> Column:
    return rul < C.DANGER_BELOW


def is_warning(rul: Column) -> Column:
    return (rul >= C.DANGER_BELOW) & (rul < C.WARNING_BELOW)


def is_healthy(rul: Column) -> Column:
    return rul >= C.WARNING_BELOW


def life_category(max_cycle: Column) -> Column:
    """Bucket a whole life; a null life counts as long, as an SQL ELSE does."""
    short, normal, long = C.LIFE_LABELS
    return (
        F.when(max_cycle < C.SHORT_LIFE_BELOW, F.lit(short))
        .when(max_cycle < C.NORMAL_LIFE_BELOW, F.lit(normal))
        .otherwise(F.lit(long))
    )


def action_for(status: Column) -> Column:
    """Recommended action, looked up in a constant map; unknown status gives null."""
    pairs = [F.lit(part) for pair in C.ACTIONS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), status)


def status_style(status: Column) -> Column:
    """Display class of a status cell."""
    return (
        F.when(status.contains("DANGER"), F.lit("status-danger"))
        .when(status.contains("WARNING"), F.lit("status-warning"))
        .otherwise(F.lit("status-ok"))
    )


def clip_above(value: Column, upper: int = C.RUL_CAP) -> Column:
    """Clip at ``upper``; unlike ``least`` a null stays null."""
    return F.when(value > upper, F.lit(upper)).otherwise(value)


def cycle_ratio(cycle: Column, max_cycle: Column) -> Column:
    return F.try_divide(cycle.cast("double"), max_cycle.cast("double"))


def late_life_flag(ratio: Column, above: float = C.LATE_LIFE_RATIO) -> Column:
    return ratio > F.lit(above)


def correlation_band(abs_r: Column) -> Column:
    bands = C.CORRELATION_BANDS
    rule = F.when(abs_r >= bands[0][0], F.lit(bands[0][1]))
    for low, name in bands[1:]:
        rule = rule.when(abs_r >= low, F.lit(name))
    return rule.otherwise(F.lit("weak"))


def fleet_banner(danger: Column, warning: Column) -> Column:
    return (
        F.when(danger > 0, F.lit("critical"))
        .when(warning > 0, F.lit("warning"))
        .otherwise(F.lit("ok"))
    )
