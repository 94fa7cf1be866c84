"""Reports of pipelines, alerts, costs and retention over logs made from the test tables, with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlake.logs import NOW, log, with_logs
from driftlake.operators import monitoring as m
from driftlake.registry import Registry
from driftlake.sources.tables import scan

R = Registry()
_NOW = f"TIMESTAMP '{NOW}'"
_MIN = "date_diff('minute', {0}, {1})"
_SEC = "date_diff('second', start_time, end_time)"
_DAY = f"start_time >= {_NOW} - INTERVAL 24 HOUR"

#: The reports that others are made from, as common table expressions.
_STREAMS = f"sh AS (SELECT p.table_name, p.stream_name, s.stale_after < {_NOW} AS is_stale, s.stale_after, round({_MIN.format(_NOW, 's.stale_after')} / 60.0, 2)::DOUBLE AS hours_until_stale, s.has_data AS has_pending_data, CASE WHEN s.stale_after IS NULL THEN 'ERROR' WHEN s.stale_after < {_NOW} THEN 'STALE' ELSE 'ACTIVE' END AS stream_status FROM pipelines p LEFT JOIN streams s ON p.table_name = s.table_name WHERE p.is_active)"
_TASKS = f"th AS (SELECT p.table_name, r.status AS task_state, r.end_time AS last_run, date_diff('second', r.start_time, r.end_time) AS last_run_seconds, r.error_message AS last_return_value, {_MIN.format('r.end_time', _NOW)} AS minutes_since_last_run, coalesce(r.status = 'SUCCESS' AND {_MIN.format('r.end_time', _NOW)} < p.alert_minutes, false) AS is_healthy FROM pipelines p LEFT JOIN (SELECT * FROM runs WHERE {_DAY} QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY end_time DESC, run_id DESC) = 1) r ON r.table_name = p.table_name WHERE p.is_active)"
_HEALTH = "CASE WHEN stream_status = 'STALE' THEN 'CRITICAL' WHEN is_healthy THEN 'HEALTHY' WHEN NOT is_healthy THEN 'CRITICAL' ELSE 'WARNING' END"
_BOARD = f"db AS (SELECT p.table_name, p.priority, th.task_state, th.last_run, th.minutes_since_last_run, th.is_healthy, sh.stream_status, sh.hours_until_stale, sh.has_pending_data, {_HEALTH} AS overall_health FROM pipelines p LEFT JOIN th ON th.table_name = p.table_name LEFT JOIN sh ON sh.table_name = p.table_name WHERE p.is_active)"
_SOURCE = "SELECT concat('T', CAST(user_id AS STRING)) AS table_name, ts, event_type <> 'error' AS passes, event_id FROM {events}"
_QM = f"src AS ({_SOURCE.replace('STRING', 'VARCHAR').replace('{events}', 'events')}), qc AS (SELECT table_name, date_trunc('day', ts) AS snapshot, count(*) AS source_rows, count(*) FILTER (passes) AS filtered_rows, count(*) FILTER (passes AND event_id % 9 > 0) AS target_rows FROM src GROUP BY 1, 2), qm AS (SELECT *, CASE WHEN match_pct >= 99 THEN 'HEALTHY' WHEN match_pct >= 95 THEN 'WARNING' ELSE 'CRITICAL' END AS quality_status FROM (SELECT *, CASE WHEN filtered_rows > 0 THEN round(100.0 * target_rows / filtered_rows, 2)::DOUBLE ELSE 100.0 END AS match_pct FROM qc))"
_BASE = with_logs("pipelines", "streams", "runs", "alerts").rstrip() + f", {_STREAMS}, {_TASKS}, {_BOARD}, {_QM} "


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _metrics(spark, sf):
    """A source log by table, and a target that lacks a ninth of what passes."""
    source = spark.sql(_SOURCE, events=scan(spark, sf, "events"))
    return m.quality_metrics(source, source.where("passes and event_id % 9 > 0"))


def _parts(spark, sf):
    p, s, r, a = (log(spark, sf, n) for n in ("pipelines", "streams", "runs", "alerts"))
    streams, tasks = m.stream_health(p, s, _now()), m.task_health(p, r, _now())
    return p, r, a, streams, tasks, m.pipeline_dashboard(p, tasks, streams), _metrics(spark, sf)


def over(name: str, use, sql: str) -> None:
    R.add(name, lambda spark, sf: use(*_parts(spark, sf)), _BASE + sql)


over("stream_health", lambda p, r, a, s, t, d, q: s, "SELECT * FROM sh")
over("task_health", lambda p, r, a, s, t, d, q: t, "SELECT * FROM th")
_OPEN = "NOT EXISTS (SELECT 1 FROM alerts a WHERE a.alert_type = '{0}' AND a.table_name = {1}.table_name AND NOT a.is_acknowledged AND a.created_at > " + _NOW + " - INTERVAL {2} HOUR)"
over(
    "generate_alerts",
    lambda p, r, a, s, t, d, q: m.generate_alerts(s, t, a, _now()),
    f"SELECT 'STREAM_STALE' AS alert_type, 'CRITICAL' AS severity, table_name, 'Stream ' || stream_name || ' is STALE for table ' || table_name AS message FROM sh WHERE stream_status = 'STALE' AND {_OPEN.format('STREAM_STALE', 'sh', 1)} UNION ALL SELECT 'TASK_FAILURE', 'CRITICAL', table_name, 'Task of ' || table_name || ' failed or unhealthy. Last return: ' || coalesce(last_return_value, 'N/A') FROM th WHERE NOT is_healthy AND {_OPEN.format('TASK_FAILURE', 'th', 1)} UNION ALL SELECT 'STREAM_STALENESS_WARNING', 'WARNING', table_name, 'Stream ' || stream_name || ' approaching staleness: ' || hours_until_stale::VARCHAR || ' hours remaining' FROM sh WHERE stream_status = 'ACTIVE' AND hours_until_stale < 12 AND {_OPEN.format('STREAM_STALENESS_WARNING', 'sh', 4)}",
)
over("pipeline_dashboard", lambda p, r, a, s, t, d, q: d, "SELECT * FROM db")
over("active_alerts", lambda p, r, a, s, t, d, q: m.active_alerts(a, _now()), f"SELECT *, {_MIN.format('created_at', _NOW)} AS minutes_open FROM alerts WHERE NOT is_acknowledged")
_CLOSED = "SELECT alert_id, alert_type, severity, table_name, is_acknowledged OR {0} AS is_acknowledged, created_at, CASE WHEN {0} THEN '{1}' END AS acknowledged_by, CASE WHEN {0} THEN " + _NOW + " END AS acknowledged_at, CASE WHEN {0} THEN {2} END AS resolution_notes FROM alerts"
over("acknowledge_alert", lambda p, r, a, s, t, d, q: m.acknowledge(a, F.col("alert_id") == 40, "ops", _now(), "fixed"), _CLOSED.format("(alert_id = 40)", "ops", "'fixed'"))
over("acknowledge_table_alerts", lambda p, r, a, s, t, d, q: m.acknowledge(a, (F.col("table_name") == "T3") & ~F.col("is_acknowledged"), "ops", _now()), _CLOSED.format("(table_name = 'T3' AND NOT is_acknowledged)", "ops", "CAST(NULL AS VARCHAR)"))
over("task_history", lambda p, r, a, s, t, d, q: m.task_history(r, _now()), f"SELECT run_id, table_name, status, start_time, end_time, {_SEC} AS duration_seconds, error_message FROM runs WHERE {_DAY}")
over("pipeline_trend_7d", lambda p, r, a, s, t, d, q: m.pipeline_trend(q, _now()), f"SELECT snapshot::DATE AS day, table_name, sum(source_rows)::DOUBLE / count(*) AS avg_source_rows, sum(filtered_rows)::DOUBLE / count(*) AS avg_filtered_rows, sum(target_rows)::DOUBLE / count(*) AS avg_target_rows, sum(match_pct::DECIMAL(28,4))::DOUBLE / count(*) AS avg_match_pct, count(*) FILTER (quality_status = 'HEALTHY') AS healthy_snapshots, count(*) FILTER (quality_status = 'WARNING') AS warning_snapshots, count(*) FILTER (quality_status = 'CRITICAL') AS critical_snapshots FROM qm WHERE snapshot >= {_NOW} - INTERVAL 7 DAY GROUP BY 1, 2")
over("filter_impact", lambda p, r, a, s, t, d, q: m.filter_impact(q), "SELECT table_name, source_rows, filtered_rows, match_pct, quality_status, source_rows - filtered_rows AS rows_excluded, round(100.0 * (source_rows - filtered_rows) / source_rows, 2)::DOUBLE AS exclusion_pct FROM qm QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY snapshot DESC) = 1")
over("pipeline_summary", lambda p, r, a, s, t, d, q: m.pipeline_summary(p, t, s, a), "SELECT count(*) AS total_pipelines, count(*) FILTER (p.is_active) AS active_pipelines, count(*) FILTER (th.is_healthy) AS healthy_tasks, count(*) FILTER (NOT th.is_healthy) AS unhealthy_tasks, count(*) FILTER (sh.stream_status = 'STALE') AS stale_streams, (SELECT count(*) FROM alerts WHERE NOT is_acknowledged) AS open_alerts FROM pipelines p LEFT JOIN th ON th.table_name = p.table_name LEFT JOIN sh ON sh.table_name = p.table_name")
over("pipeline_status_report", lambda p, r, a, s, t, d, q: m.pipeline_status_report(d, a), "SELECT db.table_name, overall_health, last_run, count(a.alert_id) AS open_alerts, count(a.alert_id) FILTER (a.severity = 'CRITICAL') AS critical_alerts FROM db LEFT JOIN alerts a ON a.table_name = db.table_name AND NOT a.is_acknowledged GROUP BY 1, 2, 3")
over("pipeline_status", lambda p, r, a, s, t, d, q: m.pipeline_status(r), "SELECT table_name, arg_max(status, (start_time, run_id)) AS last_status, max(start_time) AS last_run, max(start_time) FILTER (status = 'SUCCESS') AS last_success, arg_max(error_message, (start_time, run_id)) FILTER (status IN ('FAILED', 'ERROR')) AS last_error FROM runs GROUP BY 1")
over("cdc_errors", lambda p, r, a, s, t, d, q: m.errors(r, _now(), 72), f"SELECT run_id, table_name, status, error_message, start_time FROM runs WHERE status IN ('FAILED', 'ERROR') AND start_time >= {_NOW} - INTERVAL 72 HOUR")
_STATS = f"count(*) AS runs, count(*) FILTER (status = 'SUCCESS') AS succeeded, count(*) FILTER (status IN ('FAILED', 'ERROR')) AS failed, sum(n_inserted + n_updated + n_deleted)::BIGINT AS rows_processed, sum({_SEC})::DOUBLE / count(*) AS mean_seconds, max({_SEC}) AS most_seconds FROM runs WHERE {_DAY}"
over("execution_stats_24h", lambda p, r, a, s, t, d, q: m.execution_stats(r, ["table_name"], _now()), f"SELECT table_name, {_STATS} GROUP BY 1")
over("schedule_group_dashboard", lambda p, r, a, s, t, d, q: m.execution_stats(r, ["schedule_group"], _now()), f"SELECT schedule_group, {_STATS} GROUP BY 1")
over("refresh_history", lambda p, r, a, s, t, d, q: m.refresh_history(r), f"SELECT run_id, table_name, status, start_time, {_SEC} AS duration_seconds, n_inserted AS rows_inserted, n_updated AS rows_updated, n_deleted AS rows_deleted FROM runs")
over("refresh_cost", lambda p, r, a, s, t, d, q: m.refresh_cost(r), f"SELECT table_name, start_time::DATE AS day, count(*) AS refreshes, sum({_SEC})::BIGINT AS total_seconds, round(sum({_SEC}) / 3600.0, 4)::DOUBLE AS total_hours FROM runs GROUP BY 1, 2")
over("freshness_sla_alert", lambda p, r, a, s, t, d, q: m.freshness_sla_alert(r, _now(), 300), f"SELECT table_name, last_success, {_MIN.format('last_success', _NOW)} AS lag_minutes FROM (SELECT table_name, max(end_time) FILTER (status = 'SUCCESS') AS last_success FROM runs GROUP BY 1) WHERE last_success IS NULL OR {_MIN.format('last_success', _NOW)} > 300")
over("dq_alert", lambda p, r, a, s, t, d, q: m.dq_alert(q, 95.0), "SELECT table_name, match_pct, quality_status FROM qm QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY snapshot DESC) = 1 AND match_pct < 95")
_PERF = f"count(*) AS tests, sum(n_inserted + n_updated + n_deleted)::BIGINT AS total_rows, sum({_SEC})::BIGINT AS total_seconds, min({_SEC}) AS least_seconds, max({_SEC}) AS most_seconds, sum(n_inserted + n_updated + n_deleted)::DOUBLE / nullif(sum({_SEC}), 0) AS rows_per_second FROM runs WHERE status = 'SUCCESS'"
over("perf_by_operation", lambda p, r, a, s, t, d, q: m.perf_by(r, "operation"), f"SELECT operation, {_PERF} GROUP BY 1")
over("perf_by_batch_size", lambda p, r, a, s, t, d, q: m.perf_by(r, "size_class", "operation"), f"SELECT size_class, operation, {_PERF} GROUP BY 1, 2")
over("perf_baseline", lambda p, r, a, s, t, d, q: m.perf_baseline(r, "operation"), f"SELECT operation, quantile_cont({_SEC}::DOUBLE, 0.5) AS p50, quantile_cont({_SEC}::DOUBLE, 0.95) AS p95 FROM runs WHERE status = 'SUCCESS' GROUP BY 1")


# --- usage of three services: purchases, clicks and views as calls of models ---
_USED = "SELECT '{0}' AS service, CAST(ts AS DATE) AS day, concat('model_', CAST(user_id % 4 AS STRING)) AS model, value AS credits FROM events WHERE event_type = '{0}'"
_USAGE = "WITH u AS (" + " UNION ALL ".join(_USED.format(s) for s in ("purchase", "click", "view")) + ") "


def _usage(spark, sf):
    e = scan(spark, sf, "events")
    part = lambda s: e.where(F.col("event_type") == s).select(F.to_date("ts").alias("day"), F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model"), F.col("value").alias("credits"))
    return m.usage_cost({s: part(s) for s in ("purchase", "click", "view")}, 3.0)


_PRICED = "SELECT service, day, model, count(*) AS calls, sum(credits::DECIMAL(28,4))::DOUBLE AS credits, sum(credits::DECIMAL(28,4))::DOUBLE * 3.0::DOUBLE AS cost FROM u GROUP BY 1, 2, 3"
over("quality_metrics", lambda p, r, a, s, t, d, q: q, "SELECT * REPLACE (snapshot::TIMESTAMP AS snapshot) FROM qm")
over("processing_stats", lambda p, r, a, s, t, d, q: m.processing_stats(p, r), f"SELECT table_name, count(*) AS total_runs, count(*) FILTER (status = 'SUCCESS') AS success_count, count(*) FILTER (status IN ('FAILED', 'ERROR')) AS failed_count, count(*) FILTER (status = 'RECOVERED') AS recovery_count, sum(n_inserted + n_updated + n_deleted)::BIGINT AS rows_processed, round(avg({_SEC}), 2) AS mean_seconds, max(end_time) AS last_run FROM runs WHERE table_name IN (SELECT table_name FROM pipelines) GROUP BY 1")
over("recent_errors", lambda p, r, a, s, t, d, q: m.recent_errors(p, r), "SELECT table_name, run_id, error_message, start_time, end_time FROM runs WHERE status IN ('FAILED', 'ERROR') AND table_name IN (SELECT table_name FROM pipelines) ORDER BY start_time DESC, run_id DESC LIMIT 50")
over("failure_alert", lambda p, r, a, s, t, d, q: m.failure_alert(r, _now(), 240, 3), f"SELECT table_name, count(*) AS failures, arg_max(error_message, (start_time, run_id)) AS last_error FROM runs WHERE status IN ('FAILED', 'ERROR') AND start_time >= {_NOW} - INTERVAL 240 HOUR GROUP BY 1 HAVING count(*) >= 3")
_MERGED = "SELECT {0} AS id, CASE WHEN {0} % 10 = 0 THEN 'DELETE' WHEN {0} % 10 < 4 THEN 'UPDATE' ELSE 'INSERT' END AS cdc_operation, {0} % 10 = 0 AS is_deleted, {1} AS cdc_timestamp, concat('B', CAST({0} % 7 AS STRING)) AS source_load_batch_id FROM {2}"
_COUNTED = "SELECT '{0}' AS table_name, count(*) AS total_records, count(*) FILTER (cdc_operation = 'INSERT') AS total_inserts, count(*) FILTER (cdc_operation = 'UPDATE') AS total_updates, count(*) FILTER (cdc_operation = 'DELETE') AS total_deletes, count(*) FILTER (NOT is_deleted) AS active_records, count(*) FILTER (is_deleted) AS deleted_records, max(cdc_timestamp) AS latest_change, max(source_load_batch_id) AS latest_batch FROM ({1})"


def _merged(spark, sf, key, ts, table):
    return spark.sql(_MERGED.format(key, ts, "{rows}"), rows=scan(spark, sf, table))


_SHAPES = {"orders": ("o_orderkey", "o_orderdate"), "events": ("event_id", "ts")}
R.add("operations_by_table", lambda spark, sf: m.operations_by_table({n: _merged(spark, sf, *c, n) for n, c in _SHAPES.items()}), " UNION ALL ".join(_COUNTED.format(n, _MERGED.format(*c, n)) for n, c in _SHAPES.items()))
R.add("cdc_batch_stats", lambda spark, sf: m.cdc_batch_stats(_merged(spark, sf, "o_orderkey", "o_orderdate", "orders")), f"SELECT source_load_batch_id, cdc_operation, count(*) AS n_records, min(cdc_timestamp) AS first_change, max(cdc_timestamp) AS last_change FROM ({_MERGED.format('o_orderkey', 'o_orderdate', 'orders')}) GROUP BY 1, 2")
R.add("usage_cost", _usage, _USAGE + _PRICED)
R.add("usage_top_models", lambda spark, sf: m.top_models(_usage(spark, sf), 3), _USAGE + "SELECT model, sum(credits::DECIMAL(28,4))::DOUBLE AS credits, count(*) AS calls FROM u GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")


# --- retention over the test tables ---
def _tables(spark, sf):
    return {n: scan(spark, sf, n) for n in ("orders", "lineitem", "events", "customer")}


_DATES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
_OLD = "SELECT '{0}' AS table_name, count(*) AS rows_before, count(*) FILTER ({1} < TIMESTAMP '1996-01-01') AS rows_deleted, count(*) FILTER ({1} IS NULL OR {1} >= TIMESTAMP '1996-01-01') AS rows_after, 'SUCCESS' AS status FROM {0}"
_SKIPPED = "SELECT 'customer' AS table_name, count(*) AS rows_before, 0::BIGINT AS rows_deleted, count(*) AS rows_after, 'SKIPPED' AS status FROM customer"


def _then():
    return F.lit("1996-01-11").cast("timestamp_ntz")


R.add("retention_schema_run", lambda spark, sf: m.retention_schema_run(_tables(spark, sf), "*e*", ["events"], _DATES, 10, _then()), " UNION ALL ".join([_SKIPPED, _OLD.format("lineitem", "l_shipdate"), _OLD.format("orders", "o_orderdate")]))
_CONFIGS = [{"name": "sales", "pattern": "*", "excluded": ["events"], "date_cols": _DATES, "days": 10}, {"name": "off", "pattern": "*", "date_cols": _DATES, "days": 1, "active": False}, {"name": "log", "pattern": "ev*", "date_cols": _DATES, "days": 10}]
_SALES = "SELECT 'sales' AS config, * FROM (" + " UNION ALL ".join([_SKIPPED, _OLD.format("lineitem", "l_shipdate"), _OLD.format("orders", "o_orderdate")]) + ")"
R.add("retention_by_config", lambda spark, sf: m.retention_by_config(_tables(spark, sf), _CONFIGS, _then(), "sales"), _SALES)
R.add("retention_all", lambda spark, sf: m.retention_by_config(_tables(spark, sf), _CONFIGS, _then()), f"{_SALES} UNION ALL SELECT 'log' AS config, * FROM ({_OLD.format('events', 'ts')})")
_CLEAN = with_logs("cleanups")
R.add("cleanup_summary", lambda spark, sf: m.cleanup_summary(log(spark, sf, "cleanups")), _CLEAN + "SELECT table_name, count(*) AS runs, sum(rows_deleted)::BIGINT AS rows_deleted, count(*) FILTER (status = 'FAILED') AS failed, max(run_at) AS last_run FROM cleanups GROUP BY 1")
R.add("recent_cleanups", lambda spark, sf: m.recent_cleanups(log(spark, sf, "cleanups"), _now(), 7), _CLEAN + f"SELECT * FROM cleanups WHERE run_at >= {_NOW} - INTERVAL 7 DAY")
R.add("failed_cleanups", lambda spark, sf: m.failed_cleanups(log(spark, sf, "cleanups")), _CLEAN + "SELECT * FROM cleanups WHERE status = 'FAILED'")


def _monitoring_cleanup(spark, sf):
    kept = m.monitoring_cleanup({"runs": (log(spark, sf, "runs"), "start_time"), "alerts": (log(spark, sf, "alerts"), "created_at")}, _now(), 14)
    return kept["runs"].select(F.lit("runs").alias("log"), F.col("run_id").alias("id")).unionByName(kept["alerts"].select(F.lit("alerts").alias("log"), F.col("alert_id").alias("id")))


R.add("monitoring_cleanup", _monitoring_cleanup, with_logs("runs", "alerts") + f"SELECT 'runs' AS log, run_id AS id FROM runs WHERE start_time >= {_NOW} - INTERVAL 14 DAY UNION ALL SELECT 'alerts', alert_id FROM alerts WHERE created_at >= {_NOW} - INTERVAL 14 DAY OR NOT is_acknowledged")
R.add("backup_retention", lambda spark, sf: m.backup_retention(log(spark, sf, "cleanups").select("table_name", F.col("run_at").alias("taken_at")), _now(), 14), _CLEAN + f"SELECT table_name, run_at AS taken_at FROM cleanups c WHERE run_at < {_NOW} - INTERVAL 14 DAY AND run_at < (SELECT max(run_at) FROM cleanups d WHERE d.table_name = c.table_name)")


def _profile(spark, sf):
    t = _tables(spark, sf)
    of = lambda key, date: {"n_rows": F.count("*"), "n_keys": F.countDistinct(key), "newest": F.max(date)}
    return m.table_profile({"orders": (t["orders"], of("o_orderkey", "o_orderdate")), "lineitem": (t["lineitem"], of("l_orderkey", "l_shipdate")), "events": (t["events"], of("event_id", "ts"))})


R.add("lateral_table_profile", _profile, "SELECT 'orders' AS table_name, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, max(o_orderdate) AS newest FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), max(l_shipdate) FROM lineitem UNION ALL SELECT 'events', count(*), count(DISTINCT event_id), max(ts) FROM events")
