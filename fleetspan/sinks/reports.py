"""Report rows, documents and exports."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health, scalars
from fleetspan.operators import serving
from fleetspan.plans.shared import staged


def export_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with a header; ``compression`` as Spark names it, read back without being told."""
    df.write.option("header", True).option("compression", compression).mode("overwrite").csv(path)


def stamped_name(spark: SparkSession, prefix: str = "maintenance_report") -> str:
    """A report name with the current time."""
    return spark.range(1).select(F.concat(F.lit(f"{prefix}_"), scalars.stamp(scalars.STAMP_FILE))).first()[0]


def _row_html(status: Column) -> Column:
    return F.format_string(
        '<tr class="%s"><td>Engine %d</td><td>%s cycles</td><td>%s</td></tr>',
        health.status_style(status),
        F.col("engine_id"),
        F.coalesce(F.col("rul_capped").cast("int").cast("string"), F.lit("—")),
        status,
    )


def _by_urgency(*columns: str) -> Column:
    """Rows of a short list as an array, least life first and unknown life last."""
    rows = F.collect_list(
        F.struct(F.col("rul_capped").isNull().alias("unknown"), "rul_capped", "dataset", "engine_id", *columns)
    )
    return F.array_sort(rows)


def alert_rows(latest: DataFrame, warnings: int = 5) -> DataFrame:
    """HTML rows of all danger engines and of the first warnings, one per engine."""
    danger = serving.danger_list(latest).withColumn("health_status", F.lit("DANGER"))
    warning = serving.top_warnings(latest, warnings).withColumn("health_status", F.lit("WARNING"))
    return (
        danger.unionByName(warning)
        .withColumn("html", _row_html(F.col("health_status")))
        .select("dataset", "engine_id", "rul_capped", "health_status", "html")
    )


def _in_order(html: str = "html") -> Column:
    """Lines of a short list as one text, least life first and unknown life last."""
    return F.expr(f"listagg({html}, '\\n') WITHIN GROUP (ORDER BY rul_capped ASC NULLS LAST, dataset, engine_id)")


def report_body(latest: DataFrame, k: int = 7) -> DataFrame:
    """The critical list (k engines) as one HTML fragment, most urgent first."""
    rows = serving.critical_engines(latest, k).withColumn("html", _row_html(F.col("health_status")))
    return rows.agg(F.coalesce(_in_order(), F.lit("")).alias("body"))


MAIL = """<html><body>
<h2>Engine health report of {{at}}</h2>
<h3>Immediate maintenance: {{danger}} engines</h3>
<table><tr><th>Engine</th><th>Remaining</th><th>Status</th></tr>
{{danger_rows}}
</table>
<p>{{unlisted}} further engines in danger are in the alert table.</p>
<h3>Maintenance soon: {{warning_listed}} of {{warning}} engines</h3>
<table><tr><th>Engine</th><th>Remaining</th><th>Status</th></tr>
{{warning_rows}}
</table>
</body></html>"""
NO_ROWS = '<tr><td colspan="3">None</td></tr>'


def alert_mail(latest: DataFrame, listed: int = 100, warnings: int = 5, at: Column | None = None) -> DataFrame:
    """Subject and body of the alert mail as one row; no row where no engine is in danger or flagged.

    The body holds the ``listed`` most urgent engines; all of them are rows of ``alert_rows`` and of the alert table.
    """

    def lines(rows: DataFrame, status: str) -> DataFrame:
        return rows.withColumn("html", _row_html(F.lit(status))).agg(F.coalesce(_in_order(), F.lit(NO_ROWS)).alias("rows"))

    danger = serving.danger_list(latest).orderBy("rul_capped", "dataset", "engine_id").limit(listed)
    warning = serving.top_warnings(latest, warnings)
    counts = (
        gate(latest)
        .where("report_due")
        .withColumn("at", scalars.stamp(scalars.STAMP_MAIL, at))
        .withColumn("danger_rows", lines(danger, "DANGER").scalar())
        .withColumn("warning_rows", lines(warning, "WARNING").scalar())
        .withColumn("unlisted", F.greatest(F.col("danger") - listed, F.lit(0)))
        .withColumn("warning_listed", F.least(F.col("warning"), F.lit(warnings)))
    )
    markers = {f"{{{{{c}}}}}": c for c in ("at", "danger", "danger_rows", "unlisted", "warning_listed", "warning", "warning_rows")}
    subject = F.format_string("Engine alert: %d engines need attention now (%s)", "danger", "at")
    return fill_template(counts.withColumn("subject", subject), MAIL, markers, "body", keep=["subject"])


def alert_sections(latest: DataFrame, warnings: int = 5) -> DataFrame:
    """Headline counts of the alert report per status."""
    status = serving.with_status(latest)
    return (
        status.where(F.col("health_status").isin("DANGER", "WARNING"))
        .groupBy("health_status")
        .agg(F.count("*").alias("engines"))
        .withColumn(
            "heading",
            F.when(
                F.col("health_status") == "DANGER",
                F.format_string("Immediate maintenance required (%d engines)", "engines"),
            ).otherwise(
                F.format_string(f"Schedule maintenance soon (top {warnings} of %d)", "engines")
            ),
        )
    )


def _kpis(latest: DataFrame) -> DataFrame:
    """One row: counts by status, mean and least life, and the life histogram."""
    life = F.col("rul_capped")
    edges = C.RUL_BIN_EDGES
    bins = F.array(*[F.count_if((life >= lo) & (life < hi)) for lo, hi in zip(edges, edges[1:])])
    return latest.agg(
        F.count("*").alias("total"),
        F.count_if(health.is_danger(life)).alias("danger"),
        F.count_if(health.is_warning(life)).alias("warning"),
        F.count_if(health.is_healthy(life)).alias("healthy"),
        F.coalesce(F.round(F.avg(life), 1), F.lit(0.0)).alias("avg_rul"),
        F.coalesce(F.min(life), F.lit(0)).alias("min_rul"),
        bins.alias("rul_hist"),
    )


def kpi_document(latest: DataFrame, k: int = 7, stamped: bool = True) -> DataFrame:
    """One JSON document: counts, averages, life histogram and the critical list."""
    listed = F.transform(_by_urgency("health_status"), lambda r: r.dropFields("unknown"))
    critical = serving.critical_engines(latest, k).agg(listed)
    document = _kpis(latest).withColumn("critical", critical.scalar())
    if stamped:
        document = document.withColumn("updated", scalars.stamp(scalars.STAMP_PAGE))
    return document.select(F.to_json(F.struct(*document.columns)).alias("document"))


def fill_template(
    kpis: DataFrame, template: str, markers: dict[str, str], name: str = "page", keep: list[str] | None = None
) -> DataFrame:
    """Replace each marker of a page by a column of the one-row KPI frame."""
    page = F.lit(template)
    for marker, column in markers.items():
        page = F.replace(page, F.lit(marker), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return kpis.select(*(keep or []), page.alias(name))


PAGE = """<html><body>
<p>Updated {{updated}}</p>
<p><b>{{total}}</b> engines: {{danger}} in danger, {{warning}} on warning, {{healthy}} healthy</p>
<p>Remaining life: {{avg_rul}} cycles on average, {{min_rul}} at least</p>
<table>
{{table_rows}}
</table>
<script>const histogram = {{rul_hist}};</script>
</body></html>"""
PAGE_MARKERS = ("updated", "total", "danger", "warning", "healthy", "avg_rul", "min_rul", "table_rows", "rul_hist")


def kpi_page(latest: DataFrame, template: str = PAGE, k: int = 7, at: Column | None = None) -> DataFrame:
    """The published page: counts, averages, the critical list, the histogram and the time, put into a template."""
    kpis = (
        _kpis(latest)
        .withColumn("min_rul", F.col("min_rul").cast("int"))
        .withColumn("rul_hist", F.to_json("rul_hist"))
        .withColumn("table_rows", report_body(latest, k).scalar())
        .withColumn("updated", scalars.stamp(scalars.STAMP_PAGE, at))
    )
    return fill_template(kpis, template, {f"{{{{{c}}}}}": c for c in PAGE_MARKERS})


def alerts_to_emit(latest: DataFrame) -> DataFrame:
    """Rows of the alert report: engines in danger or flagged; empty means no report."""
    return latest.where(
        F.coalesce(health.is_danger(F.col("rul_capped")), F.lit(False))
        | F.coalesce(F.col("is_anomaly"), F.lit(False))
    ).select(*C.KEYS, "cycle", "rul_capped", "is_anomaly")


def emit_alerts(latest: DataFrame, path: str, day: str | None = None) -> bool:
    """Write the alert rows of a day (today, unless given) to a table path; True if there were any.

    The table is partitioned by day. A day that is reported again replaces what it had, so a rerun
    leaves the same rows; other days are not touched. Where there are none nothing is written.
    """
    rows = staged(alerts_to_emit(latest), "alerts")  # looked at twice
    if rows.isEmpty():
        return False
    (
        rows.withColumn("report_day", F.lit(day).cast("date") if day else F.current_date())
        .withColumn("reported_at", F.current_timestamp())
        .write.partitionBy("report_day")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    return True


def gate(latest: DataFrame) -> DataFrame:
    """One row: danger, warning and anomaly counts, and whether a report is due."""
    life = F.col("rul_capped")
    return latest.agg(
        F.count_if(health.is_danger(life)).alias("danger"),
        F.count_if(health.is_warning(life)).alias("warning"),
        F.count_if("is_anomaly").alias("anomalies"),
    ).withColumn("report_due", (F.col("danger") > 0) | (F.col("anomalies") > 0))
