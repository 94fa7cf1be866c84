"""Health of pipelines, alerts and their state, run statistics, costs and retention: reports over run logs.

runs: table_name, status, start_time, end_time, ...; pipelines: table_name, is_active, alert_minutes, ...;
streams: table_name, stale_after, has_data; alerts: alert_id, alert_type, severity, table_name, is_acknowledged, created_at."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.sources.tables import united

#: Hours in which an open alert of the same kind and table keeps a new one back; hours before staleness at which one is warned.
SUPPRESSED = {"STREAM_STALE": 1, "TASK_FAILURE": 1, "STREAM_STALENESS_WARNING": 4}
WARN_HOURS = 12
FAILED = ("FAILED", "ERROR")


def _minutes(start: Column, end: Column) -> Column:
    """Boundaries of minutes crossed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def _seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def stream_health(pipelines: DataFrame, streams: DataFrame, now: Column) -> DataFrame:
    """A row for each active pipeline: hours until its stream is stale, and STALE, ACTIVE or ERROR (no stream)."""
    rows = pipelines.where("is_active").join(streams, "table_name", "left")
    hours = F.round(_minutes(now, F.col("stale_after")) / 60.0, 2)
    stale = F.col("stale_after") < now
    status = F.when(F.col("stale_after").isNull(), "ERROR").when(stale, "STALE").otherwise("ACTIVE")
    return rows.select("table_name", "stream_name", stale.alias("is_stale"), "stale_after", hours.alias("hours_until_stale"), F.col("has_data").alias("has_pending_data"), status.alias("stream_status"))


def task_health(pipelines: DataFrame, runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """The latest run of each active pipeline in the last hours; healthy if it succeeded and is recent enough."""
    recent = runs.where(F.col("start_time") >= now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    last = recent.groupBy("table_name").agg(F.max_by(F.struct("status", "start_time", "end_time", "error_message"), F.struct("end_time", "run_id")).alias("r"))
    rows = pipelines.where("is_active").join(last, "table_name", "left")
    since = _minutes(F.col("r.end_time"), now)
    healthy = F.coalesce((F.col("r.status") == "SUCCESS") & (since < F.col("alert_minutes")), F.lit(False))
    return rows.select("table_name", F.col("r.status").alias("task_state"), F.col("r.end_time").alias("last_run"), _seconds(F.col("r.start_time"), F.col("r.end_time")).alias("last_run_seconds"), F.col("r.error_message").alias("last_return_value"), since.alias("minutes_since_last_run"), healthy.alias("is_healthy"))


def generate_alerts(streams: DataFrame, tasks: DataFrame, alerts: DataFrame, now: Column) -> DataFrame:
    """New alerts of three kinds, but where an open one of the kind and table is younger than the kind's hours."""
    kind = lambda df, name, severity, message: df.select(F.lit(name).alias("alert_type"), F.lit(severity).alias("severity"), "table_name", message.alias("message"))
    stale = kind(streams.where("stream_status = 'STALE'"), "STREAM_STALE", "CRITICAL", F.concat(F.lit("Stream "), "stream_name", F.lit(" is STALE for table "), "table_name"))
    failed = kind(tasks.where("not is_healthy"), "TASK_FAILURE", "CRITICAL", F.concat(F.lit("Task of "), "table_name", F.lit(" failed or unhealthy. Last return: "), F.coalesce("last_return_value", F.lit("N/A"))))
    near = streams.where(f"stream_status = 'ACTIVE' and hours_until_stale < {WARN_HOURS}")
    warned = kind(near, "STREAM_STALENESS_WARNING", "WARNING", F.concat(F.lit("Stream "), "stream_name", F.lit(" approaching staleness: "), F.col("hours_until_stale").cast("string"), F.lit(" hours remaining")))
    span = F.create_map(*[F.lit(x) for pair in SUPPRESSED.items() for x in pair])
    open_ = alerts.where(~F.col("is_acknowledged")).where(F.col("created_at") > now - F.make_dt_interval(F.lit(0), span[F.col("alert_type")]))
    return stale.unionByName(failed).unionByName(warned).join(open_.select("alert_type", "table_name").distinct(), ["alert_type", "table_name"], "left_anti")


def pipeline_dashboard(pipelines: DataFrame, tasks: DataFrame, streams: DataFrame) -> DataFrame:
    rows = pipelines.where("is_active").join(tasks, "table_name", "left").join(streams.drop("stream_name"), "table_name", "left")
    overall = F.when(F.col("stream_status") == "STALE", "CRITICAL").when(F.col("is_healthy"), "HEALTHY").when(~F.col("is_healthy"), "CRITICAL").otherwise("WARNING")
    return rows.select("table_name", "priority", "task_state", "last_run", "minutes_since_last_run", "is_healthy", "stream_status", "hours_until_stale", "has_pending_data", overall.alias("overall_health"))


def active_alerts(alerts: DataFrame, now: Column) -> DataFrame:
    return alerts.where(~F.col("is_acknowledged")).withColumn("minutes_open", _minutes(F.col("created_at"), now))


def acknowledge(alerts: DataFrame, which: Column, by: str, at: Column, notes: str | None = None) -> DataFrame:
    """The alerts with those that which names (by id, or open ones of a table) closed."""
    hit = F.coalesce(which, F.lit(False))
    return alerts.withColumns({"is_acknowledged": F.col("is_acknowledged") | hit, "acknowledged_by": F.when(hit, by), "acknowledged_at": F.when(hit, at), "resolution_notes": F.when(hit, F.lit(notes))})


def task_history(runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    recent = runs.where(F.col("start_time") >= now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return recent.select("run_id", "table_name", "status", "start_time", "end_time", _seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"), "error_message")


def quality_metrics(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows counted each day (snapshot) for each table in the source, of these after filters, and in the target, and how much of what
    passed the target has: HEALTHY from 99 %, WARNING from 95 %.

    source: table_name, ts, passes; target: table_name, ts. Both are counted before they meet."""
    day = F.date_trunc("day", "ts").alias("snapshot")
    came = source.groupBy("table_name", day).agg(F.count("*").alias("source_rows"), F.count_if("passes").alias("filtered_rows"))
    held = target.groupBy("table_name", day).agg(F.count("*").alias("target_rows"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    both = came.join(held, ["table_name", "snapshot"], "full").select("table_name", "snapshot", *map(zero, ("source_rows", "filtered_rows", "target_rows")))
    pct = F.when(F.col("filtered_rows") > 0, F.round(100.0 * F.col("target_rows") / F.col("filtered_rows"), 2)).otherwise(100.0)
    status = F.when(F.col("match_pct") >= 99, "HEALTHY").when(F.col("match_pct") >= 95, "WARNING").otherwise("CRITICAL")
    return both.withColumn("match_pct", pct).withColumn("quality_status", status)


def processing_stats(pipelines: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs of each configured table by outcome, rows that they processed, mean seconds, and the last end."""
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    known = runs.join(pipelines.select("table_name").distinct(), "table_name", "left_semi")
    seconds = F.round(F.avg(_seconds(F.col("start_time"), F.col("end_time"))), 2)
    return known.groupBy("table_name").agg(F.count("*").alias("total_runs"), of("SUCCESS").alias("success_count"), of(*FAILED).alias("failed_count"), of("RECOVERED").alias("recovery_count"), F.sum(F.col("n_inserted") + F.col("n_updated") + F.col("n_deleted")).alias("rows_processed"), seconds.alias("mean_seconds"), F.max("end_time").alias("last_run"))


def recent_errors(pipelines: DataFrame, runs: DataFrame, n: int = 50) -> DataFrame:
    """The last n failed runs of configured tables, newest first."""
    failed = runs.where(F.col("status").isin(*FAILED)).join(pipelines.select("table_name").distinct(), "table_name", "left_semi")
    return failed.select("table_name", "run_id", "error_message", "start_time", "end_time").orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)


def failure_alert(runs: DataFrame, now: Column, hours: int, least: int) -> DataFrame:
    """Tables with so many failed runs within the last hours, and the last one's message."""
    recent = runs.where((F.col("start_time") >= now - F.make_dt_interval(F.lit(0), F.lit(hours))) & F.col("status").isin(*FAILED))
    return recent.groupBy("table_name").agg(F.count("*").alias("failures"), F.max_by("error_message", F.struct("start_time", "run_id")).alias("last_error")).where(F.col("failures") >= least)


def operations_by_table(targets: dict[str, DataFrame]) -> DataFrame:
    """Records of each merged table by their last operation, live and deleted, with the newest change and batch."""
    of = lambda s: F.count_if(F.col("cdc_operation") == s)
    figures = {"total_records": F.count("*"), "total_inserts": of("INSERT"), "total_updates": of("UPDATE"), "total_deletes": of("DELETE"), "active_records": F.count_if(~F.col("is_deleted")), "deleted_records": F.count_if("is_deleted"), "latest_change": F.max("cdc_timestamp"), "latest_batch": F.max("source_load_batch_id")}
    return united([df.agg(*[f.alias(k) for k, f in figures.items()]).select(F.lit(n).alias("table_name"), "*") for n, df in targets.items()], "table_name string, total_records long, total_inserts long, total_updates long, total_deletes long, active_records long, deleted_records long, latest_change timestamp_ntz, latest_batch string")


def cdc_batch_stats(target: DataFrame) -> DataFrame:
    """Records of a merged table by the batch and operation that wrote them last."""
    return target.groupBy("source_load_batch_id", "cdc_operation").agg(F.count("*").alias("n_records"), F.min("cdc_timestamp").alias("first_change"), F.max("cdc_timestamp").alias("last_change"))


def pipeline_trend(metrics: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Daily averages of each table's metrics over the last days."""
    recent = metrics.where(F.col("snapshot") >= now - F.make_dt_interval(F.lit(days)))
    mean = lambda c: (F.sum(F.col(c).cast("decimal(28,4)")).cast("double") / F.count(c)).alias(f"avg_{c}")
    of = lambda s: F.count_if(F.col("quality_status") == s).alias(f"{s.lower()}_snapshots")
    return recent.groupBy(F.to_date("snapshot").alias("day"), "table_name").agg(*map(mean, ("source_rows", "filtered_rows", "target_rows", "match_pct")), *map(of, ("HEALTHY", "WARNING", "CRITICAL")))


def filter_impact(metrics: DataFrame) -> DataFrame:
    """Rows that filters leave out, at each table's last snapshot."""
    last = metrics.groupBy("table_name").agg(F.max_by(F.struct("source_rows", "filtered_rows", "match_pct", "quality_status"), "snapshot").alias("m")).select("table_name", "m.*")
    out = F.col("source_rows") - F.col("filtered_rows")
    return last.withColumns({"rows_excluded": out, "exclusion_pct": F.when(F.col("source_rows") > 0, F.round(100.0 * out / F.col("source_rows"), 2)).otherwise(0.0)})


def pipeline_summary(pipelines: DataFrame, tasks: DataFrame, streams: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = pipelines.join(tasks, "table_name", "left").join(streams.drop("stream_name"), "table_name", "left")
    figures = rows.agg(F.count("*").alias("total_pipelines"), F.count_if("is_active").alias("active_pipelines"), F.count_if("is_healthy").alias("healthy_tasks"), F.count_if(~F.col("is_healthy")).alias("unhealthy_tasks"), F.count_if(F.col("stream_status") == "STALE").alias("stale_streams"))
    return figures.crossJoin(alerts.agg(F.count_if(~F.col("is_acknowledged")).alias("open_alerts")))


def pipeline_status_report(dashboard: DataFrame, alerts: DataFrame) -> DataFrame:
    open_ = alerts.where(~F.col("is_acknowledged")).groupBy("table_name").agg(F.count("*").alias("open_alerts"), F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"))
    return dashboard.select("table_name", "overall_health", "last_run").join(open_, "table_name", "left").fillna(0, ["open_alerts", "critical_alerts"])


def pipeline_status(runs: DataFrame) -> DataFrame:
    """Each table's last run, last success and last error."""
    order = F.struct("start_time", "run_id")
    good = F.col("status") == "SUCCESS"
    bad = F.col("status").isin(*FAILED)
    return runs.groupBy("table_name").agg(F.max_by("status", order).alias("last_status"), F.max("start_time").alias("last_run"), F.max(F.when(good, F.col("start_time"))).alias("last_success"), F.max_by(F.when(bad, F.col("error_message")), F.when(bad, order)).alias("last_error"))


def errors(runs: DataFrame, now: Column, hours: int) -> DataFrame:
    rows = runs.where(F.col("status").isin(*FAILED) & (F.col("start_time") >= now - F.make_dt_interval(F.lit(0), F.lit(hours))))
    return rows.select("run_id", "table_name", "status", "error_message", "start_time")


def execution_stats(runs: DataFrame, by: Sequence[str], now: Column, hours: int = 24) -> DataFrame:
    recent = runs.where(F.col("start_time") >= now - F.make_dt_interval(F.lit(0), F.lit(hours))).withColumn("s", _seconds(F.col("start_time"), F.col("end_time")))
    rows = F.col("n_inserted") + F.col("n_updated") + F.col("n_deleted")
    return recent.groupBy(*by).agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "SUCCESS").alias("succeeded"), F.count_if(F.col("status").isin(*FAILED)).alias("failed"), F.sum(rows).alias("rows_processed"), (F.sum("s") / F.count("s")).alias("mean_seconds"), F.max("s").alias("most_seconds"))


def refresh_history(runs: DataFrame) -> DataFrame:
    """Runs with duration and row counts read from their nested statistics."""
    stats = F.struct(F.col("n_inserted").alias("inserted"), F.col("n_updated").alias("updated"), F.col("n_deleted").alias("deleted"))
    rows = runs.withColumn("statistics", F.to_json(stats))
    read = lambda k: F.get_json_object("statistics", f"$.{k}").cast("long").alias(f"rows_{k}")
    return rows.select("run_id", "table_name", "status", "start_time", _seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"), read("inserted"), read("updated"), read("deleted"))


def refresh_cost(runs: DataFrame) -> DataFrame:
    """Seconds and hours of refreshing, by table and day."""
    s = _seconds(F.col("start_time"), F.col("end_time"))
    return runs.groupBy("table_name", F.to_date("start_time").alias("day")).agg(F.count("*").alias("refreshes"), F.sum(s).alias("total_seconds"), F.round(F.sum(s) / 3600.0, 4).alias("total_hours"))


def freshness_sla_alert(runs: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Tables whose last success is older than their bound, or that never had one."""
    last = runs.groupBy("table_name").agg(F.max(F.when(F.col("status") == "SUCCESS", F.col("end_time"))).alias("last_success"))
    lag = _minutes(F.col("last_success"), now)
    return last.withColumn("lag_minutes", lag).where(F.col("lag_minutes").isNull() | (F.col("lag_minutes") > minutes))


def dq_alert(metrics: DataFrame, least_pct: float) -> DataFrame:
    """Tables whose last snapshot matches too little."""
    return filter_impact(metrics).where(F.col("match_pct") < least_pct).select("table_name", "match_pct", "quality_status")


def perf_by(runs: DataFrame, *by: str) -> DataFrame:
    """Rows, seconds and throughput of successful runs in groups."""
    rows = F.col("n_inserted") + F.col("n_updated") + F.col("n_deleted")
    good = runs.where("status = 'SUCCESS'").withColumns({"rows": rows, "s": _seconds(F.col("start_time"), F.col("end_time"))})
    return good.groupBy(*by).agg(F.count("*").alias("tests"), F.sum("rows").alias("total_rows"), F.sum("s").alias("total_seconds"), F.min("s").alias("least_seconds"), F.max("s").alias("most_seconds"), (F.sum("rows") / F.nullif(F.sum("s"), F.lit(0))).alias("rows_per_second"))


def perf_baseline(runs: DataFrame, *by: str) -> DataFrame:
    """Median and 95th percentile (continuous) of seconds in groups, from counts of each value: no group's values meet in one row."""
    counts = runs.where("status = 'SUCCESS'").groupBy(*by, _seconds(F.col("start_time"), F.col("end_time")).cast("double").alias("s")).agg(F.count("*").alias("n"))
    return percentiles(counts, list(by), "s", "n", {"p50": 0.5, "p95": 0.95})


def percentiles(counts: DataFrame, by: list[str], value: str, n: str, shares: dict[str, float]) -> DataFrame:
    """Continuous percentiles from distinct values and their counts."""
    order = Window.partitionBy(*by).orderBy(value)
    whole = Window.partitionBy(*by)
    rows = counts.withColumns({"__upto": F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, 0)), "__all": F.sum(n).over(whole)})
    out = []
    for name, share in shares.items():
        at = (F.col("__all") - 1) * share
        lo, hi = F.floor(at), F.ceil(at)
        holds = lambda k: F.max(F.when((F.col("__upto") > k) & (F.col("__upto") - F.col(n) <= k), F.col(value)))  # noqa: B023, E731
        a, b = holds(lo), holds(hi)
        out.append((a + (b - a) * F.max(at - lo)).alias(name))
    return rows.groupBy(*by).agg(*out)


def usage_cost(parts: dict[str, DataFrame], price: float) -> DataFrame:
    """Credits and cost by day, service and model over the union of the services' logs (day, model, credits)."""
    every = reduce(DataFrame.unionByName, [df.select(F.lit(s).alias("service"), "day", "model", "credits") for s, df in parts.items()])
    total = F.sum(F.col("credits").cast("decimal(28,4)")).cast("double")
    return every.groupBy("service", "day", "model").agg(F.count("*").alias("calls"), total.alias("credits"), (total * price).alias("cost"))


def top_models(usage: DataFrame, k: int) -> DataFrame:
    total = F.sum(F.col("credits").cast("decimal(28,4)")).cast("double").alias("credits")
    return usage.groupBy("model").agg(total, F.sum("calls").alias("calls")).orderBy(F.desc("credits"), "model").limit(k)


# --- retention ---


def retention_counts(table: str, df: DataFrame, date_col: str, days: int, now: Column) -> DataFrame:
    """A row of the clean-up log: counts before and after, or SKIPPED where the column is missing."""
    if date_col not in df.columns:
        return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows_before"), F.lit(0).cast("long").alias("rows_deleted"), F.count("*").alias("rows_after"), F.lit("SKIPPED").alias("status"))
    old = F.coalesce(F.col(date_col) < now - F.make_dt_interval(F.lit(days)), F.lit(False))
    return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows_before"), F.count_if(old).alias("rows_deleted"), F.count_if(~old).alias("rows_after"), F.lit("SUCCESS").alias("status"))


def retention_schema_run(tables: dict[str, DataFrame], pattern: str, excluded: Sequence[str], date_cols: dict[str, str], days: int, now: Column) -> DataFrame:
    """The log of a run over all tables whose names match the pattern (* for any text) and that aren't excluded."""
    import fnmatch

    names = [n for n in sorted(tables) if fnmatch.fnmatchcase(n, pattern) and n not in excluded]
    return united([retention_counts(n, tables[n], date_cols.get(n, ""), days, now) for n in names], "table_name string, rows_before long, rows_deleted long, rows_after long, status string")


def retention_by_config(tables: dict[str, DataFrame], configs: Sequence[dict], now: Column, name: str | None = None) -> DataFrame:
    """The log of a run over every active config, in order, or over one of them."""
    live = [c for c in configs if c.get("active", True) and (name is None or c["name"] == name)]
    runs = [retention_schema_run(tables, c["pattern"], c.get("excluded", ()), c["date_cols"], c["days"], now).select(F.lit(c["name"]).alias("config"), "*") for c in live]
    return united(runs, "config string, table_name string, rows_before long, rows_deleted long, rows_after long, status string")


def cleanup_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("table_name").agg(F.count("*").alias("runs"), F.sum("rows_deleted").alias("rows_deleted"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.max("run_at").alias("last_run"))


def recent_cleanups(log: DataFrame, now: Column, days: int) -> DataFrame:
    return log.where(F.col("run_at") >= now - F.make_dt_interval(F.lit(days)))


def failed_cleanups(log: DataFrame) -> DataFrame:
    return log.where("status = 'FAILED'")


def monitoring_cleanup(logs: dict[str, tuple[DataFrame, str]], now: Column, days: int) -> dict[str, DataFrame]:
    """What stays of each log (with its time column): rows young enough; alerts also while nobody has acknowledged them."""
    limit = now - F.make_dt_interval(F.lit(days))
    young = lambda df, ts: (F.col(ts) >= limit) | (~F.col("is_acknowledged") if "is_acknowledged" in df.columns else F.lit(False))
    return {name: df.where(young(df, ts)) for name, (df, ts) in logs.items()}


def backup_retention(copies: DataFrame, now: Column, days: int) -> DataFrame:
    """Dated copies (path, taken_at) that are too old, the newest of each table aside."""
    newest = Window.partitionBy("table_name")
    rows = copies.withColumn("__newest", F.max("taken_at").over(newest))
    return rows.where((F.col("taken_at") < now - F.make_dt_interval(F.lit(days))) & (F.col("taken_at") < F.col("__newest"))).drop("__newest")


def table_profile(tables: dict[str, tuple[DataFrame, dict[str, Callable]]]) -> DataFrame:
    """Figures of each table beside its name: one aggregation a table, united."""
    return united([df.agg(*[f.alias(k) for k, f in figures.items()]).select(F.lit(n).alias("table_name"), "*") for n, (df, figures) in tables.items()], "table_name string")
