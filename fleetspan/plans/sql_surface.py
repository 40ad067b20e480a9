"""The fleet as SQL: temp views and a table function."""

from pyspark.sql import DataFrame, SparkSession

from fleetspan import constants as C
from fleetspan.operators import lives
from fleetspan.plans.binding import Fleet


def register_views(spark: SparkSession, fleet: Fleet) -> None:
    """Create ``readings``, ``engines``, ``rul_labels`` and ``v_engine_health``."""
    fleet.readings.createOrReplaceTempView("readings")
    fleet.engines.createOrReplaceTempView("engines")
    fleet.labels.createOrReplaceTempView("rul_labels")
    lives.rul_health(fleet.readings, fleet.engines).createOrReplaceTempView("v_engine_health")


def register_alert_function(spark: SparkSession) -> None:
    """``maintenance_alerts(dataset, threshold)`` as an SQL table function."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION maintenance_alerts(
            target_dataset STRING, danger_threshold INT)
        RETURNS TABLE (engine_id BIGINT, dataset STRING, current_cycle INT, failure_cycle INT,
                       cycles_remaining INT, alert_message STRING)
        RETURN SELECT engine_id, dataset, cycle, max_cycle, remaining_useful_life, '{C.ALERT_MESSAGE}'
               FROM v_engine_health
               WHERE dataset = target_dataset
                 AND cycle = max_cycle
                 AND remaining_useful_life <= danger_threshold
        """
    )


def maintenance_alerts_sql(spark: SparkSession, fleet: Fleet, threshold: int) -> DataFrame:
    """The table function called beside a list of data sets; the view is read once for all of them."""
    register_views(spark, fleet)
    register_alert_function(spark)
    named = ", ".join(f"('{dataset}')" for dataset in C.DATASETS)
    return spark.sql(
        f"""
        SELECT alerts.* FROM VALUES {named} AS wanted(target),
            LATERAL maintenance_alerts(wanted.target, {threshold}) AS alerts
        """
    )
