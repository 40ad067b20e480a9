"""Reference SQL for every registered query, run by DuckDB on the same tables."""

from fleetspan import constants as C

# The lineitem binding in SQL; see ``plans.binding`` for the Spark form.
FLEET = """
WITH items AS (
  SELECT *, l_orderkey // 180 * 3 + CASE WHEN l_orderkey // 30 % 6 = 0 THEN 0 WHEN l_orderkey // 30 % 6 <= 2 THEN 1 ELSE 2 END AS engine_id
  FROM lineitem),
r0 AS (
  SELECT engine_id,
         concat('FD00', CAST(1 + engine_id % 4 AS VARCHAR(10))) AS dataset,
         CAST(row_number() OVER (PARTITION BY engine_id
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS cycle,
         CAST(7 + (engine_id * 29) % 139 AS INT) AS true_rul,
         l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t
  FROM items),
r1 AS (SELECT *, CAST(cycle AS DOUBLE) AS c FROM r0),
readings AS (
  SELECT engine_id, dataset, cycle,
         d - CAST(0.05 AS DOUBLE) AS op_setting_1,
         t - CAST(0.04 AS DOUBLE) AS op_setting_2,
         CAST(100.0 AS DOUBLE) AS op_setting_3,
         CAST(518.67 AS DOUBLE) AS sensor_1,
         CAST(641.0 AS DOUBLE) + CAST(0.02 AS DOUBLE) * q + CAST(0.005 AS DOUBLE) * c AS sensor_2,
         CAST(1580.0 AS DOUBLE) + CAST(0.2 AS DOUBLE) * q + CAST(0.05 AS DOUBLE) * c AS sensor_3,
         CAST(1400.0 AS DOUBLE) + CAST(0.25 AS DOUBLE) * q + CAST(0.06 AS DOUBLE) * c AS sensor_4,
         CAST(14.62 AS DOUBLE) AS sensor_5,
         CAST(21.61 AS DOUBLE) AS sensor_6,
         CAST(554.0 AS DOUBLE) - CAST(10.0 AS DOUBLE) * d - CAST(0.004 AS DOUBLE) * c AS sensor_7,
         CAST(2388.0 AS DOUBLE) + t AS sensor_8,
         CAST(9050.0 AS DOUBLE) + CAST(0.0002 AS DOUBLE) * p AS sensor_9,
         CAST(1.3 AS DOUBLE) AS sensor_10,
         CAST(47.2 AS DOUBLE) + CAST(5.0 AS DOUBLE) * t + CAST(0.002 AS DOUBLE) * c AS sensor_11,
         CAST(521.5 AS DOUBLE) - CAST(0.00001 AS DOUBLE) * p - CAST(0.003 AS DOUBLE) * c AS sensor_12,
         CAST(2388.0 AS DOUBLE) + d AS sensor_13,
         CAST(8140.0 AS DOUBLE) + CAST(0.0001 AS DOUBLE) * p + d AS sensor_14,
         CAST(8.4 AS DOUBLE) + d + CAST(0.0005 AS DOUBLE) * c AS sensor_15,
         CAST(0.03 AS DOUBLE) AS sensor_16,
         CAST(392.0 AS DOUBLE) + CAST(0.01 AS DOUBLE) * c AS sensor_17,
         CAST(2388.0 AS DOUBLE) AS sensor_18,
         CAST(100.0 AS DOUBLE) AS sensor_19,
         CAST(38.9 AS DOUBLE) - t - CAST(0.001 AS DOUBLE) * c AS sensor_20,
         CAST(23.3 AS DOUBLE) - d - CAST(0.0006 AS DOUBLE) * c AS sensor_21
  FROM r1),
engines AS (
  SELECT engine_id, dataset, max(cycle) AS max_cycle FROM readings GROUP BY engine_id, dataset),
rul_labels AS (SELECT DISTINCT engine_id, dataset, true_rul FROM r0),
test_readings AS (
  SELECT r.* FROM readings r JOIN engines e ON r.engine_id = e.engine_id AND r.dataset = e.dataset
  JOIN rul_labels l ON r.engine_id = l.engine_id AND r.dataset = l.dataset
  WHERE r.cycle <= greatest(31, e.max_cycle - l.true_rul)),
readings_nulls AS (
  SELECT engine_id, dataset, cycle,
         CASE WHEN cycle % 17 = 0 THEN NULL ELSE sensor_2 END AS sensor_2,
         sensor_7, CAST(NULL AS DOUBLE) AS empty_col
  FROM readings),
health AS (
  SELECT r.*, e.max_cycle, e.max_cycle - r.cycle AS rul,
         CASE WHEN e.max_cycle - r.cycle > 125 THEN 125 ELSE e.max_cycle - r.cycle END AS rul_cap
  FROM readings r JOIN engines e ON r.engine_id = e.engine_id AND r.dataset = e.dataset),
test_lives AS (
  SELECT dataset, engine_id, max(cycle) AS max_cycle FROM test_readings GROUP BY dataset, engine_id),
serving AS (
  SELECT t.dataset, t.engine_id, t.cycle, t.sensor_2, t.sensor_7, t.sensor_11, t.sensor_12,
         CAST(CASE WHEN l.true_rul + v.max_cycle - t.cycle > 125 THEN 125
              ELSE l.true_rul + v.max_cycle - t.cycle END AS INT) AS rul_capped,
         CAST(t.cycle AS DOUBLE) / CAST(v.max_cycle AS DOUBLE) > CAST(0.9 AS DOUBLE) AS is_anomaly,
         CAST(t.cycle AS DOUBLE) / CAST(v.max_cycle AS DOUBLE) AS cycle_ratio
  FROM test_readings t
  JOIN test_lives v ON t.engine_id = v.engine_id AND t.dataset = v.dataset
  JOIN rul_labels l ON t.engine_id = l.engine_id AND t.dataset = l.dataset),
latest AS (
  SELECT s.*, CASE WHEN rul_capped < 30 THEN 'DANGER' WHEN rul_capped < 80 THEN 'WARNING'
                   ELSE 'HEALTHY' END AS status
  FROM serving s
  WHERE cycle = (SELECT max(x.cycle) FROM serving x
                 WHERE x.engine_id = s.engine_id AND x.dataset = s.dataset))
"""

FEED = """
WITH feed AS (
  SELECT user_id AS engine_id, ts, value AS rul,
         CASE WHEN value < 30 THEN 'DANGER' WHEN value < 80 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
  FROM events)
"""

_STATUS = "CASE WHEN rul < 30 THEN 'DANGER' WHEN rul < 80 THEN 'WARNING' ELSE 'NORMAL' END"
_LIFE = (
    "CASE WHEN max_cycle < 150 THEN 'Short Life (Under 150)' "
    "WHEN max_cycle < 250 THEN 'Normal Life (150-250)' ELSE 'Long Life (Over 250)' END"
)
_FRAME = "OVER (PARTITION BY dataset, engine_id ORDER BY cycle ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
_HELD_OUT = (
    "md5(concat_ws('|', dataset, CAST(engine_id AS VARCHAR), CAST(cycle AS VARCHAR), '42')) "
    "< '33333333333333333333333333333333'"
)
_KEY4 = ["sensor_2", "sensor_7", "sensor_11", "sensor_12"]
_PROFILE5 = [*_KEY4, "sensor_15"]
_NUMERIC = ["cycle", *C.SETTINGS, *C.SENSORS]
_USEFUL = [s for s in C.SENSORS if s not in ("sensor_1", "sensor_5", "sensor_6", "sensor_10", "sensor_16", "sensor_18", "sensor_19")]
_EDGES = list(zip(C.RUL_BIN_EDGES, C.RUL_BIN_EDGES[1:]))


def _list(template: str, items, sep: str = ", ") -> str:
    return sep.join(template.format(s=s) for s in items)


def _r(value: str, digits: int = 6) -> str:
    """Rounding with the same digits in every engine; see ``registry._rounded``."""
    return f"floor(round({value}, {digits + 4}) * 1e{digits} + 0.5) / 1e{digits}"


def _unpivot(columns, source: str, extra: str = "") -> str:
    """(column_name, value) pairs as one UNION ALL branch per column."""
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns
    )


def _equal_width(value: str, bins: int, source: str) -> str:
    return f"""
, v AS (SELECT dataset, {value} AS v FROM {source}),
m AS (SELECT dataset, CAST(min(v) AS DOUBLE) AS lo, CAST(max(v) AS DOUBLE) AS hi FROM v GROUP BY dataset),
b AS (SELECT dataset, CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo,
             CASE WHEN hi > lo THEN hi ELSE hi + 0.5 END AS hi FROM m),
x AS (SELECT v.dataset, least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS INT), {bins - 1}) AS bin
      FROM v JOIN b ON v.dataset = b.dataset),
n AS (SELECT dataset, bin, count(*) AS n FROM x GROUP BY dataset, bin),
g AS (SELECT b.*, CAST(i AS INT) AS bin FROM b, range(0, {bins}) t(i))
SELECT g.dataset, g.bin,
       round(lo + g.bin * ((hi - lo) / CAST({bins} AS DOUBLE)), 4) AS bin_from,
       round(lo + (g.bin + 1) * ((hi - lo) / CAST({bins} AS DOUBLE)), 4) AS bin_to,
       coalesce(n.n, 0) AS n
FROM g LEFT JOIN n ON g.dataset = n.dataset AND g.bin = n.bin"""


def _correlations() -> str:
    pairs = [(a, b) for a in _USEFUL for b in _USEFUL]
    columns = ", ".join(f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(pairs))
    rows = ", ".join(
        "{" + f"'sensor_a': '{a}', 'sensor_b': '{b}', 'r': r{i}" + "}" for i, (a, b) in enumerate(pairs)
    )
    return f"""
, wide AS (SELECT {columns} FROM readings),
matrix AS (SELECT unnest([{rows}], recursive := true) FROM wide)"""


_SUMMARIES = """
, early AS (SELECT engine_id, dataset, avg(sensor_2) AS s2e, avg(sensor_11) AS s11e
            FROM readings WHERE cycle <= 50 GROUP BY engine_id, dataset),
late AS (SELECT r.engine_id, r.dataset, avg(sensor_2) AS s2l, avg(sensor_11) AS s11l
         FROM readings r JOIN engines e ON r.engine_id = e.engine_id AND r.dataset = e.dataset
         WHERE r.cycle >= e.max_cycle - 50 GROUP BY r.engine_id, r.dataset)
SELECT e.engine_id, e.dataset, e.max_cycle AS total_life,
       round(s2e, 4) AS sensor_2_early, round(s2l, 4) AS sensor_2_late, round(s2l - s2e, 4) AS sensor_2_change,
       round(s11e, 4) AS sensor_11_early, round(s11l, 4) AS sensor_11_late,
       round(s11l - s11e, 4) AS sensor_11_change
FROM engines e JOIN early a ON e.engine_id = a.engine_id AND e.dataset = a.dataset
JOIN late b ON e.engine_id = b.engine_id AND e.dataset = b.dataset"""

_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT dataset, '{s}' AS sensor_name, round(avg({s}), 4) AS average_value, "
    f"round(stddev_pop({s}), 4) AS std_deviation, round(min({s}), 4) AS min_value, "
    f"round(max({s}), 4) AS max_value FROM readings GROUP BY dataset"
    for s in _PROFILE5
)

_ALERTS = """
SELECT r.engine_id, r.dataset, r.cycle AS current_cycle, e.max_cycle AS failure_cycle,
       e.max_cycle - r.cycle AS cycles_remaining, 'IMMEDIATE MAINTENANCE REQUIRED' AS alert_message
FROM readings r JOIN engines e ON r.engine_id = e.engine_id AND r.dataset = e.dataset
WHERE r.cycle = e.max_cycle AND e.max_cycle - r.cycle <= 30"""

_VIEW = f"""
SELECT engine_id, dataset, cycle, max_cycle, rul AS remaining_useful_life, {_STATUS} AS health_status,
       sensor_2, sensor_7, sensor_11, sensor_12 FROM health"""

_SERVING_COLUMNS = "dataset, engine_id, cycle, sensor_2, sensor_7, sensor_11, sensor_12, rul_capped, is_anomaly, cycle_ratio"
_RAW = "engine_id, dataset, cycle, " + ", ".join([*C.SETTINGS, *C.SENSORS])

_ROW_HTML = (
    "printf('<tr class=\"%s\"><td>Engine %d</td><td>%d cycles</td><td>%s</td></tr>', "
    "CASE WHEN st = 'DANGER' THEN 'status-danger' WHEN st = 'WARNING' THEN 'status-warning' ELSE 'status-ok' END, "
    "engine_id, rul_capped, st)"
)
_TOP7 = """
, top7 AS (SELECT dataset, engine_id, rul_capped,
             CASE WHEN rul_capped < 30 THEN 'DANGER' WHEN rul_capped < 80 THEN 'WARNING' ELSE 'OK' END AS st
           FROM latest ORDER BY rul_capped NULLS LAST, dataset, engine_id LIMIT 7)"""

_LINKS = r"""
WITH parts AS (
  SELECT page_id, url,
    unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
    unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 2)) AS inner_html
  FROM pages),
links AS (SELECT page_id, url, href, trim(regexp_replace(inner_html, '<[^>]*>', '', 'g')) AS link_text FROM parts)"""
_LINK_HIT = "(lower(link_text) LIKE '%the%' OR lower(link_text) LIKE '%tion%' OR lower(href) LIKE '%tion%')"

_CATALOG = "(VALUES " + ", ".join(
    f"('{name}', {pos}, '{text}', " + (f"'{unit}'" if unit else "NULL") + ")"
    for pos, name, text, unit in C.COLUMN_CATALOG
) + ") AS catalog(sensor_name, position, description, unit)"

_PREDICTED = "CAST(rul_cap AS DOUBLE) + (sensor_2 - CAST(642.0 AS DOUBLE)) * CAST(4.0 AS DOUBLE)"


def oracle_queries() -> dict[str, str]:
    fleet = {
        # --- SQL analysis
        "fleet_summary": """SELECT dataset, count(DISTINCT engine_id) AS total_engines, min(max_cycle) AS shortest_life,
            max(max_cycle) AS longest_life, round(avg(max_cycle), 1) AS average_life FROM engines GROUP BY dataset""",
        "readings_per_dataset": "SELECT dataset, count(*) AS total_readings FROM readings GROUP BY dataset",
        "life_category": f"SELECT engine_id, dataset, max_cycle AS total_life_in_cycles, {_LIFE} AS life_category FROM engines",
        "life_category_summary": f"""SELECT dataset, {_LIFE} AS life_category, count(*) AS number_of_engines,
            round(avg(max_cycle), 1) AS avg_life_in_category FROM engines GROUP BY 1, 2""",
        "rank_longevity": """SELECT engine_id, dataset, max_cycle,
            rank() OVER (PARTITION BY dataset ORDER BY max_cycle DESC) AS rank_by_longevity,
            round(max_cycle - avg(max_cycle) OVER (PARTITION BY dataset), 1) AS difference_from_average,
            round(CAST(100 AS DOUBLE) * rank() OVER (PARTITION BY dataset ORDER BY max_cycle)
                  / count(*) OVER (PARTITION BY dataset), 1) AS percentile FROM engines""",
        "cycle_delta": """SELECT engine_id, dataset, cycle, sensor_2,
            lag(sensor_2) OVER w AS previous_cycle_sensor_2,
            round(sensor_2 - lag(sensor_2) OVER w, 4) AS change_from_last_cycle
            FROM readings WINDOW w AS (PARTITION BY dataset, engine_id ORDER BY cycle)""",
        "early_life": "SELECT engine_id, dataset, "
        + _list(_r("avg({s})") + " AS avg_{s}_early", _KEY4)
        + " FROM readings WHERE cycle <= 50 GROUP BY engine_id, dataset",
        "late_life": "SELECT engine_id, dataset, "
        + _list(_r("avg({s})") + " AS avg_{s}_late", _KEY4)
        + " FROM health WHERE cycle >= max_cycle - 50 GROUP BY engine_id, dataset",
        "degradation_delta": _SUMMARIES,
        "degradation_by_joins": _SUMMARIES,
        "rul_health": _VIEW,
        "engine_health_danger": f"SELECT * FROM ({_VIEW}) WHERE health_status = 'DANGER'",
        "danger_preview": f"""SELECT * FROM ({_VIEW}) WHERE health_status = 'DANGER'
            ORDER BY dataset, engine_id, cycle LIMIT 20""",
        "maintenance_alerts": _ALERTS,
        "chosen_engines": f"SELECT * FROM ({_VIEW}) WHERE dataset = 'FD002' AND engine_id IN (1, 5, 9)",
        "present_columns": "SELECT dataset, engine_id, cycle, sensor_2, sensor_7 FROM readings_nulls",
        "work_order_report": """SELECT dataset, engine_id AS "Engine ID", cycle AS "Last Cycle", CAST(rul_capped AS DOUBLE) AS "Estimated RUL", status AS "Status",
            CASE status WHEN 'DANGER' THEN 'Ground engine. Schedule immediate inspection.'
              WHEN 'WARNING' THEN 'Plan maintenance within 2 weeks.' ELSE 'Continue monitoring. No action needed.' END AS "Action",
            CASE status WHEN 'DANGER' THEN 'status-danger' WHEN 'WARNING' THEN 'status-warning' ELSE 'status-ok' END AS style_class
            FROM latest""",
        "stamped_alerts": f"SELECT dataset, count(*) AS alerts, CAST(0 AS BIGINT) AS unstamped FROM ({_ALERTS}) GROUP BY dataset",
        "maintenance_alerts_sql": _ALERTS,
        "life_variability": """SELECT dataset, count(DISTINCT engine_id) AS total_engines,
            round(avg(max_cycle), 0) AS avg_engine_life, min(max_cycle) AS shortest_life,
            max(max_cycle) AS longest_life, round(stddev_pop(max_cycle), 1) AS life_variability
            FROM engines GROUP BY dataset""",
        "sensor_profile": _PROFILE_SQL,
        "sensor_profile_union": _PROFILE_SQL,
        "sensor_profile_labelled": f"""SELECT p.*, position, description, unit FROM ({_PROFILE_SQL}) p
            LEFT JOIN {_CATALOG} ON p.sensor_name = catalog.sensor_name""".replace("p.*", "p.dataset, p.sensor_name, average_value, std_deviation, min_value, max_value"),
        # --- Profiling
        "describe_sensors": f"""SELECT column_name, count(value) AS "count", {_r("avg(value)", 4)} AS mean,
            {_r("stddev_samp(value)", 4)} AS std, {_r("min(value)", 4)} AS "min",
            {_r("quantile_cont(value, 0.25)", 4)} AS p25, {_r("quantile_cont(value, 0.5)", 4)} AS p50,
            {_r("quantile_cont(value, 0.75)", 4)} AS p75, {_r("max(value)", 4)} AS "max"
            FROM ({_unpivot(_NUMERIC, 'readings')}) GROUP BY column_name""",
        "profile_columns": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, count({c}) AS non_null_count FROM readings_nulls"
            for c, t in (("engine_id", "bigint"), ("dataset", "string"), ("cycle", "int"), ("sensor_2", "double"), ("sensor_7", "double"), ("empty_col", "double"))
        ),
        "missing_report": "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
            f"round(CAST(100 AS DOUBLE) * (count(*) - count({c})) / count(*), 2) AS missing_pct FROM readings_nulls"
            for c in ("engine_id", "dataset", "cycle", "sensor_2", "sensor_7", "empty_col")
        )
        + ") WHERE missing_count > 0",
        "missing_verdict": """SELECT CAST(2 * count(*) - count(sensor_2) - count(empty_col) AS BIGINT) AS missing_cells,
            count(*) = count(sensor_2) AND count(*) = count(empty_col) AS is_complete FROM readings_nulls""",
        "drop_all_null_columns": "SELECT engine_id, dataset, cycle, sensor_2, sensor_7 FROM readings_nulls",
        "constant_sensors": f"""SELECT column_name AS sensor_name, {_r("stddev_samp(value)")} AS std,
            stddev_samp(value) < 0.001 AS is_constant FROM ({_unpivot(C.SENSORS, 'readings')}) GROUP BY column_name""",
        "rul_stats": """SELECT dataset, min(rul) AS min_rul, max(rul) AS max_rul, round(avg(rul), 4) AS mean_rul
            FROM health GROUP BY dataset""",
        "correlation_matrix": _correlations() + "SELECT sensor_a, sensor_b, round(r, 4) AS r FROM matrix",
        "correlated_pairs": _correlations()
        + "SELECT sensor_a, sensor_b, round(r, 4) AS r FROM matrix WHERE sensor_a < sensor_b AND abs(round(r, 4)) >= 0.9",
        "rul_correlation": ", c AS ("
        + " UNION ALL ".join(f"SELECT '{s}' AS sensor_name, round(abs(corr({s}, rul)), 4) AS abs_r FROM health" for s in _USEFUL)
        + """) SELECT sensor_name, abs_r, CASE WHEN abs_r >= 0.65 THEN 'strong' WHEN abs_r >= 0.55 THEN 'good'
            WHEN abs_r >= 0.40 THEN 'fair' ELSE 'weak' END AS strength,
            rank() OVER (ORDER BY abs_r DESC) AS position FROM c""",
        "lifespan_histogram": """, b AS (SELECT dataset, CAST(floor((max_cycle - 125) / 25.0) AS BIGINT) AS i FROM engines)
            SELECT dataset, 125 + i * 25 AS bin_from, 125 + (i + 1) * 25 AS bin_to, count(*) AS engines FROM b GROUP BY dataset, i""",
        "mean_life": "SELECT dataset, round(avg(max_cycle), 4) AS mean_life FROM engines GROUP BY dataset",
        "lifespan_bins": _equal_width("max_cycle", 20, "engines"),
        "rul_histogram_equal": _equal_width("rul", 40, "health"),
        "fleet_rul_bins": _equal_width("rul_capped", 25, "latest"),
        "life_stage_profile": """SELECT dataset,
            least(CAST(floor(CAST(cycle AS DOUBLE) / CAST(max_cycle AS DOUBLE) * 5) AS INT), 4) AS life_stage, count(*) AS n, """
        + _list("round(avg({s}), 4) AS avg_{s}", _KEY4)
        + " FROM health GROUP BY 1, 2",
        "sensor_trends": " UNION ALL ".join(
            f"SELECT dataset, engine_id, cycle, '{s}' AS sensor_name, {s} AS reading FROM readings" for s in [*_PROFILE5, "sensor_20"]
        ),
        "preview_readings": "SELECT dataset, engine_id, cycle, max_cycle, rul AS \"RUL\" FROM health ORDER BY dataset, engine_id, cycle LIMIT 5",
        # --- Features
        "engine_lives": "SELECT engine_id, dataset, max_cycle FROM engines",
        "rolling_avg": "SELECT dataset, engine_id, cycle, "
        + _list(_r("avg({s}) " + _FRAME) + " AS {s}_rolling_avg", _KEY4)
        + " FROM readings",
        "rolling_std": "SELECT dataset, engine_id, cycle, "
        + _list(_r("coalesce(stddev_samp({s}) " + _FRAME + ", 0)") + " AS {s}_rolling_std", _KEY4)
        + " FROM readings",
        "cycle_ratio": "SELECT dataset, engine_id, cycle, CAST(cycle AS DOUBLE) / CAST(max_cycle AS DOUBLE) AS cycle_ratio FROM health",
        "rul_capped": 'SELECT dataset, engine_id, cycle, rul AS "RUL", rul_cap AS "RUL_capped" FROM health',
        "rul_from_labels": "SELECT dataset, engine_id, cycle, rul_capped FROM serving",
        "late_life_flag": "SELECT dataset, engine_id, cycle, is_anomaly FROM serving",
        "baseline_breach": f""", b AS (SELECT dataset, engine_id, avg(sensor_7) AS mu7, stddev_samp(sensor_7) AS sd7,
              avg(sensor_11) AS mu11, stddev_samp(sensor_11) AS sd11 FROM readings WHERE cycle <= 50 GROUP BY dataset, engine_id),
            s AS (SELECT dataset, engine_id, cycle, avg(sensor_7) {_FRAME} AS a7, avg(sensor_11) {_FRAME} AS a11 FROM readings)
            SELECT s.dataset, s.engine_id, s.cycle, {_r("a7")} AS sensor_7_rolling_avg, {_r("a11")} AS sensor_11_rolling_avg,
              coalesce(abs(a7 - mu7) > 1.5 * sd7, false) AS sensor_7_breach,
              coalesce(abs(a11 - mu11) > 1.5 * sd11, false) AS sensor_11_breach
            FROM s JOIN b ON s.dataset = b.dataset AND s.engine_id = b.engine_id""",
        "feature_frame": f'SELECT {_RAW}, max_cycle, rul AS "RUL", '
        + _list(_r("avg({s}) " + _FRAME) + " AS {s}_rolling_avg", _KEY4)
        + ", "
        + _list(_r("coalesce(stddev_samp({s}) " + _FRAME + ", 0)") + " AS {s}_rolling_std", _KEY4)
        + ', CAST(cycle AS DOUBLE) / CAST(max_cycle AS DOUBLE) AS cycle_ratio, rul_cap AS "RUL_capped" FROM health',
        "minmax_scaled": ", b AS (SELECT "
        + _list("min({s}) AS {s}_lo, max({s}) AS {s}_hi", [*C.SETTINGS, *C.SENSORS])
        + " FROM readings) SELECT dataset, engine_id, cycle, "
        + _list("CASE WHEN {s}_hi = {s}_lo THEN 0.0 ELSE ({s} - {s}_lo) / ({s}_hi - {s}_lo) END AS {s}", [*C.SETTINGS, *C.SENSORS])
        + " FROM readings, b",
        "hash_split": f"SELECT dataset, engine_id, cycle, {_HELD_OUT} AS held_out FROM readings",
        # --- Serving
        "serving_frame": f"SELECT {_SERVING_COLUMNS} FROM serving",
        "latest_per_engine": f"SELECT {_SERVING_COLUMNS} FROM latest",
        "latest_non_null": """SELECT dataset, engine_id, max(cycle) AS cycle, arg_max(sensor_2, cycle) FILTER (sensor_2 IS NOT NULL) AS sensor_2,
            arg_max(sensor_7, cycle) AS sensor_7, CAST(NULL AS DOUBLE) AS empty_col FROM readings_nulls GROUP BY dataset, engine_id""",
        "fleet_status": """, c AS (SELECT dataset, status AS health_status, count(*) AS engines FROM latest GROUP BY dataset, status),
            t AS (SELECT dataset, CAST(sum(engines) AS BIGINT) AS fleet_size FROM c GROUP BY dataset)
            SELECT c.dataset, health_status, engines, fleet_size,
              CAST(trunc(CAST(100 AS DOUBLE) * engines / fleet_size) AS INT) AS pct_of_fleet
            FROM c JOIN t ON c.dataset = t.dataset""",
        "rul_kpis": """SELECT dataset, count(*) AS total, count(*) FILTER (rul_capped < 30) AS danger,
            count(*) FILTER (rul_capped >= 30 AND rul_capped < 80) AS warning, count(*) FILTER (rul_capped >= 80) AS healthy,
            coalesce(round(avg(rul_capped), 1), 0) AS avg_rul, coalesce(min(rul_capped), 0) AS min_rul FROM latest GROUP BY dataset""",
        "rul_histogram": ", d AS (SELECT dataset, rul_capped FROM latest) "
        + " UNION ALL ".join(
            f"SELECT dataset, {i} AS bin, {lo} AS bin_from, {hi} AS bin_to, "
            f"count(*) FILTER (rul_capped >= {lo} AND rul_capped < {hi}) AS engines FROM d GROUP BY dataset"
            for i, (lo, hi) in enumerate(_EDGES)
        ),
        "critical_engines": _TOP7 + " SELECT dataset, engine_id, rul_capped, st AS health_status FROM top7",
        "danger_list": "SELECT dataset, engine_id, rul_capped FROM latest WHERE rul_capped < 30",
        "warning_top5": """SELECT dataset, engine_id, rul_capped FROM latest WHERE rul_capped >= 30 AND rul_capped < 80
            ORDER BY rul_capped, dataset, engine_id LIMIT 5""",
        "work_order": """SELECT dataset, engine_id, cycle AS last_cycle, CAST(rul_capped AS DOUBLE) AS estimated_rul, status,
            CASE status WHEN 'DANGER' THEN 'Ground engine. Schedule immediate inspection.'
              WHEN 'WARNING' THEN 'Plan maintenance within 2 weeks.' ELSE 'Continue monitoring. No action needed.' END AS action,
            CASE status WHEN 'DANGER' THEN 'status-danger' WHEN 'WARNING' THEN 'status-warning' ELSE 'status-ok' END AS style_class
            FROM latest""",
        "engine_history": f"SELECT {_SERVING_COLUMNS} FROM serving WHERE engine_id = 3 AND dataset = 'FD004'",
        "worst_engine_histories": f""", w AS (SELECT dataset, engine_id FROM latest
              QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY rul_capped, engine_id) = 1)
            SELECT {', '.join('s.' + c.strip() for c in _SERVING_COLUMNS.split(','))} FROM serving s JOIN w ON s.dataset = w.dataset AND s.engine_id = w.engine_id""",
        "readings_desc": f"SELECT {_SERVING_COLUMNS} FROM serving ORDER BY cycle DESC",
        "engine_cards": """, a AS (SELECT dataset, engine_id, arg_max(rul_capped, cycle) AS current_rul, max(cycle) AS cycles_lived,
              count(*) FILTER (is_anomaly) AS anomalies, count(*) AS readings FROM serving GROUP BY dataset, engine_id)
            SELECT *, CASE WHEN current_rul < 30 THEN 'DANGER' WHEN current_rul < 80 THEN 'WARNING' ELSE 'HEALTHY' END AS status FROM a""",
        "rul_gauges": """SELECT dataset, engine_id, rul_capped AS gauge_value, rul_capped - 80 AS gauge_delta, 30 AS danger_to,
            80 AS warning_to, 125 AS gauge_max, status FROM latest""",
        "sensor_series": """SELECT dataset, engine_id, cycle, sensor_2 AS reading,
            CASE WHEN is_anomaly THEN sensor_2 END AS anomaly_marker FROM serving""",
        "fleet_banner": """, c AS (SELECT dataset, count(*) FILTER (rul_capped < 30) AS danger,
              count(*) FILTER (rul_capped >= 30 AND rul_capped < 80) AS warning FROM latest GROUP BY dataset)
            SELECT *, CASE WHEN danger > 0 THEN 'critical' WHEN warning > 0 THEN 'warning' ELSE 'ok' END AS banner FROM c""",
        "selection_list": "SELECT dataset, engine_id, concat('Engine ', CAST(engine_id AS VARCHAR), ' — ', status) AS label FROM latest",
        "status_by_engine": """SELECT s.dataset, s.engine_id, s.cycle, l.status AS health_status
            FROM serving s JOIN latest l ON s.dataset = l.dataset AND s.engine_id = l.engine_id""",
        "fleet_alerts": """SELECT dataset, engine_id, cycle AS current_cycle, rul_capped AS cycles_remaining,
            'IMMEDIATE MAINTENANCE REQUIRED' AS alert_message FROM latest WHERE rul_capped <= 30""",
        "alert_rows_html": f""", a AS (SELECT dataset, engine_id, rul_capped, 'DANGER' AS st FROM latest WHERE rul_capped < 30
              UNION ALL SELECT * FROM (SELECT dataset, engine_id, rul_capped, 'WARNING' FROM latest
                WHERE rul_capped >= 30 AND rul_capped < 80 ORDER BY rul_capped, dataset, engine_id LIMIT 5))
            SELECT dataset, engine_id, rul_capped, st AS health_status, {_ROW_HTML} AS html FROM a""",
        "report_body": _TOP7
        + f" SELECT string_agg({_ROW_HTML}, chr(10) ORDER BY rul_capped, dataset, engine_id) AS body FROM top7",
        "alert_sections": """SELECT status AS health_status, count(*) AS engines,
            CASE status WHEN 'DANGER' THEN printf('Immediate maintenance required (%d engines)', count(*))
              ELSE printf('Schedule maintenance soon (top 5 of %d)', count(*)) END AS heading
            FROM latest WHERE status <> 'HEALTHY' GROUP BY status""",
        "kpi_json": _TOP7
        + """ SELECT CAST(to_json({'total': (SELECT count(*) FROM latest),
              'danger': (SELECT count(*) FROM latest WHERE rul_capped < 30),
              'warning': (SELECT count(*) FROM latest WHERE rul_capped >= 30 AND rul_capped < 80),
              'healthy': (SELECT count(*) FROM latest WHERE rul_capped >= 80),
              'avg_rul': (SELECT round(avg(rul_capped), 1) FROM latest),
              'min_rul': (SELECT min(rul_capped) FROM latest),
              'rul_hist': ["""
        + ", ".join(f"(SELECT count(*) FROM latest WHERE rul_capped >= {lo} AND rul_capped < {hi})" for lo, hi in _EDGES)
        + """],
              'critical': (SELECT list({'rul_capped': rul_capped, 'dataset': dataset, 'engine_id': engine_id, 'health_status': st}
                           ORDER BY rul_capped, dataset, engine_id) FROM top7)}) AS VARCHAR) AS document""",
        "kpi_page": _TOP7
        + f""" SELECT concat('<html><body>', chr(10), '<p>Updated 01 Feb 2024, 08:30 UTC</p>', chr(10),
            '<p><b>', count(*), '</b> engines: ', count(*) FILTER (rul_capped < 30), ' in danger, ',
            count(*) FILTER (rul_capped >= 30 AND rul_capped < 80), ' on warning, ', count(*) FILTER (rul_capped >= 80), ' healthy</p>', chr(10),
            '<p>Remaining life: ', round(avg(rul_capped), 1), ' cycles on average, ', min(rul_capped), ' at least</p>', chr(10),
            '<table>', chr(10), (SELECT string_agg({_ROW_HTML}, chr(10) ORDER BY rul_capped, dataset, engine_id) FROM top7), chr(10), '</table>', chr(10),
            '<script>const histogram = [', """
        + ", ',', ".join(f"count(*) FILTER (rul_capped >= {lo} AND rul_capped < {hi})" for lo, hi in _EDGES)
        + """, '];</script>', chr(10), '</body></html>') AS page FROM latest""",
        "alert_mail": f""", a AS (SELECT dataset, engine_id, rul_capped, CASE WHEN rul_capped < 30 THEN 'DANGER' ELSE 'WARNING' END AS st,
              row_number() OVER (PARTITION BY rul_capped < 30 ORDER BY rul_capped, dataset, engine_id) AS nth FROM latest WHERE rul_capped < 80),
            n AS (SELECT count(*) FILTER (rul_capped < 30) AS danger, count(*) FILTER (rul_capped >= 30 AND rul_capped < 80) AS warning,
              count(*) FILTER (rul_capped < 30 OR is_anomaly) AS due FROM latest),
            lists AS (SELECT string_agg({_ROW_HTML}, chr(10) ORDER BY rul_capped, dataset, engine_id) FILTER (st = 'DANGER' AND nth <= 100) AS d,
              string_agg({_ROW_HTML}, chr(10) ORDER BY rul_capped, dataset, engine_id) FILTER (st = 'WARNING' AND nth <= 5) AS w FROM a),
            t AS (SELECT '<table><tr><th>Engine</th><th>Remaining</th><th>Status</th></tr>' || chr(10) AS head,
              '<tr><td colspan="3">None</td></tr>' AS nothing)
            SELECT printf('Engine alert: %d engines need attention now (2024-02-01 08:30)', danger) AS subject,
              concat('<html><body>', chr(10), '<h2>Engine health report of 2024-02-01 08:30</h2>', chr(10), '<h3>Immediate maintenance: ', danger,
                ' engines</h3>', chr(10), head, coalesce(d, nothing), chr(10), '</table>', chr(10), '<p>', greatest(danger - 100, 0),
                ' further engines in danger are in the alert table.</p>', chr(10), '<h3>Maintenance soon: ', least(warning, 5), ' of ', warning,
                ' engines</h3>', chr(10), head, coalesce(w, nothing), chr(10), '</table>', chr(10), '</body></html>') AS body
            FROM n, lists, t WHERE due > 0""",
        "alerts_gate": """SELECT count(*) FILTER (rul_capped < 30) AS danger,
            count(*) FILTER (rul_capped >= 30 AND rul_capped < 80) AS warning, count(*) FILTER (is_anomaly) AS anomalies,
            count(*) FILTER (rul_capped < 30) > 0 OR count(*) FILTER (is_anomaly) > 0 AS report_due FROM latest""",
        "alerts_emitted": """SELECT dataset, engine_id, cycle, rul_capped, is_anomaly, report_day FROM latest,
            (VALUES (DATE '2024-01-31'), (DATE '2024-02-01')) d(report_day) WHERE rul_capped < 30 OR is_anomaly""",
        # --- Load and sink
        "load_breakdown": """SELECT dataset, count(DISTINCT engine_id) AS number_of_engines, count(*) AS total_sensor_readings,
            min(cycle) AS min_cycle, max(cycle) AS max_cycle FROM readings GROUP BY dataset""",
        "load_report": """SELECT dataset, count(DISTINCT engine_id) AS engines_loaded, count(*) AS readings_loaded FROM readings GROUP BY dataset
            UNION ALL SELECT 'ALL', count(DISTINCT engine_id), count(*) FROM readings""",
        "table_counts": """SELECT 'engines' AS table_name, count(*) AS row_count FROM engines
            UNION ALL SELECT 'sensor_readings', count(*) FROM readings UNION ALL SELECT 'rul_labels', count(*) FROM rul_labels""",
        "insert_ignore": """SELECT engine_id, dataset, max_cycle FROM engines UNION ALL
            SELECT l.engine_id + (SELECT max(engine_id) + 1 FROM engines), l.dataset, l.true_rul FROM rul_labels l""",
        "repeated_load": "SELECT engine_id, dataset, max_cycle FROM engines",
        "text_round_trip": f"SELECT {_RAW} FROM readings",
        "label_round_trip": """SELECT dataset, CAST(row_number() OVER (PARTITION BY dataset ORDER BY engine_id) AS INT) AS engine_id, true_rul
            FROM rul_labels""",
        "feature_csv_round_trip": 'SELECT dataset, engine_id, cycle, max_cycle, rul AS "RUL", rul_cap AS "RUL_capped" FROM health',
        "serving_refresh": f"SELECT {_SERVING_COLUMNS} FROM serving",
        "nan_to_null": """SELECT engine_id, dataset, cycle, CASE WHEN cycle % 13 = 0 THEN NULL ELSE sensor_2 END AS sensor_2 FROM readings""",
        # --- Models
        "regression_metrics": f""", p AS (SELECT CAST(rul_cap AS DOUBLE) AS y, {_PREDICTED} AS yhat FROM health)
            SELECT count(*) AS n, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse, round(avg(abs(yhat - y)), 6) AS mae,
              round(1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)), 6) AS r2 FROM p""",
        "residual_histogram": f""", p AS (SELECT ({_PREDICTED}) - rul_cap AS e FROM health),
            b AS (SELECT min(e) AS lo, max(e) AS hi FROM p),
            x AS (SELECT least(CAST(floor((e - lo) / (hi - lo) * 40) AS INT), 39) AS bin, count(*) AS n FROM p, b GROUP BY 1),
            g AS (SELECT CAST(i AS INT) AS bin FROM range(0, 40) t(i))
            SELECT g.bin, {_r("lo + g.bin * ((hi - lo) / 40)")} AS bin_from, {_r("lo + (g.bin + 1) * ((hi - lo) / 40)")} AS bin_to,
              coalesce(x.n, 0) AS n FROM b, g LEFT JOIN x ON g.bin = x.bin""",
        "late_life_scatter": """SELECT dataset, engine_id, cycle, cycle_ratio * 100 AS life_pct, sensor_2, is_anomaly FROM serving""",
        "late_life_rate": """SELECT count(*) FILTER (is_anomaly) AS anomalies, count(*) AS readings,
            round(avg(CAST(is_anomaly AS INT)) * 100, 4) AS anomaly_rate_pct FROM serving""",
        "model_facts": f""", f AS (SELECT {_HELD_OUT} AS held_out FROM readings)
            SELECT 'training_rows' AS fact, CAST(count(*) FILTER (NOT held_out) AS DOUBLE) AS value FROM f
            UNION ALL SELECT 'held_out_rows', count(*) FILTER (held_out) FROM f
            UNION ALL SELECT 'predictions_in_range', count(*) FILTER (held_out) FROM f
            UNION ALL VALUES ('importances', 22), ('importance_sum', 1), ('trees', 100), ('nodes_too_deep', 0), ('leaves_too_small', 0),
              ('isolation_trees', 100), ('healthy_share_flagged', 0.05)""",
        "healthy_population": "SELECT dataset, engine_id, cycle FROM health WHERE rul >= 125",
    }
    feed = {
        "stream_latest": """SELECT engine_id, arg_max(ts, ts) AS ts, arg_max(rul, ts) AS rul, arg_max(health_status, ts) AS health_status
            FROM feed GROUP BY engine_id""",
        "stream_alerts": """SELECT engine_id, ts, rul, health_status, previous_status FROM (
              SELECT *, lag(health_status) OVER (PARTITION BY engine_id ORDER BY ts) AS previous_status FROM feed)
            WHERE health_status = 'DANGER' AND (previous_status IS NULL OR previous_status <> 'DANGER')""",
        "stream_rolling": "SELECT engine_id, ts, rul, "
        + _r("avg(rul) OVER (PARTITION BY engine_id ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
        + " AS rolling_avg FROM feed",
        "stream_kpis": f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS readings,
            count(*) FILTER (rul < 30) AS danger, {_r("avg(rul)")} AS avg_rul, min(rul) AS min_rul,
            count(DISTINCT engine_id) AS engines FROM feed GROUP BY 1""",
        "stream_kpis_daily": f"""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS readings,
            count(*) FILTER (rul < 30) AS danger, {_r("avg(rul)")} AS avg_rul, min(rul) AS min_rul,
            count(DISTINCT engine_id) AS engines FROM feed GROUP BY 1""",
        "stream_late_rows": """SELECT * FROM (VALUES ('rolling', CAST(0 AS BIGINT)), ('kpis', 0)) t(stream, late_rows)""",
    }
    plain = {
        "coerce_types": """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value,
            coalesce(TRY_CAST(CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false' END AS BOOLEAN), false) AS is_anomaly FROM events""",
        "page_links": _LINKS + "SELECT page_id, url, href, link_text FROM links",
        "relevant_links": _LINKS + f"SELECT page_id, url, href, link_text FROM links WHERE {_LINK_HIT}",
        "link_counts": _LINKS + f"SELECT count(*) AS links, count(*) FILTER ({_LINK_HIT}) AS relevant_links FROM links",
        "number_functions": """SELECT l_orderkey, round(l_quantity * CAST(0.5 AS DOUBLE)) AS half_up,
            round_even(l_quantity * CAST(0.5 AS DOUBLE), 0) AS half_even, CAST(trunc(l_extendedprice) AS INT) AS truncated,
            round(sqrt(l_extendedprice), 6) AS root, abs(l_discount - CAST(0.05 AS DOUBLE)) AS distance,
            concat('Engine ', CAST(l_suppkey AS VARCHAR), ' — ', lower(l_returnflag)) AS label,
            format('{:,}', l_partkey * 1000) AS thousands, printf('%.2f', l_quantity) AS fixed,
            strftime(l_shipdate, '%d %b %Y, %H:%M UTC') AS stamp_page, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS stamp_mail,
            strftime(l_shipdate, '%Y%m%d_%H%M') AS stamp_file FROM lineitem""",
        "text_functions": r"""SELECT doc_id, len(regexp_split_to_array(trim(text), '\s+')) AS words,
            lower(text) LIKE '%license%' OR lower(text) LIKE '%copyright%' AS mentions_terms,
            md5(replace(text, 'the', '<THE>')) AS replaced_md5 FROM documents""",
    }
    return {
        **{name: FLEET + sql for name, sql in fleet.items()},
        **{name: FEED + sql for name, sql in feed.items()},
        **plain,
    }
