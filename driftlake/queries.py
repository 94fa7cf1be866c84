"""Every operator bound to the test tables, and the same in DuckDB's SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake import audit_queries, monitoring_queries, movement_queries, table_queries
from driftlake.operators import cdc, governance, history, monitoring, movement, quality
from driftlake.sources.tables import scan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2024-06-01 00:00:00"


def query(oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def both(name: str, sql: str, oracle: str | None = None) -> None:
    """One SQL text for both engines; {table} stands for a table."""
    tables = sorted(set(re.findall(r"\{(\w+)\}", sql)))
    QUERIES[name] = lambda spark, sf, sql=sql: spark.sql(sql, **{t: scan(spark, sf, t) for t in tables})
    ORACLES[name] = oracle or re.sub(r"\{(\w+)\}", r"\1", sql)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- change data capture: orders as the base, a batch made from it by key ---


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderdate")


def _target(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.new_target(_base(spark, sf).where("o_orderkey % 7 <> 0"), F.lit("2024-01-01").cast("timestamp_ntz"), "B0")


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderkey") % 10
    b = _base(spark, sf).where(kind < 4)
    b = b.withColumns({"price": F.when(kind < 2, (F.col("price") + 1).cast("decimal(18,2)")).otherwise(F.col("price")), "cdc_action": F.when(kind == 2, "DELETE").otherwise("INSERT"), "cdc_is_update": kind < 2, "row_id": F.concat(F.lit("r"), "o_orderkey")})
    old = b.where("cdc_is_update").withColumns({"cdc_action": F.lit("DELETE"), "row_id": F.concat("row_id", F.lit("o"))})
    return b.unionByName(old)


B = "base AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate FROM orders), target AS (SELECT *, 'INSERT' AS cdc_operation, TIMESTAMP '2024-01-01' AS cdc_timestamp, false AS is_deleted, TIMESTAMP '2024-01-01' AS record_created_at, TIMESTAMP '2024-01-01' AS record_updated_at, 'B0' AS source_load_batch_id FROM base WHERE o_orderkey % 7 <> 0)"
MERGED = "SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN {put} THEN b.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, CASE WHEN {put} THEN {price} ELSE t.price END AS price, CASE WHEN {put} THEN b.o_orderdate ELSE t.o_orderdate END AS o_orderdate, {op} AS cdc_operation, CASE WHEN {hit} THEN TIMESTAMP '2024-06-01' ELSE t.cdc_timestamp END AS cdc_timestamp, CASE WHEN {cut} THEN true ELSE false END AS is_deleted, CASE WHEN t.o_orderkey IS NULL THEN TIMESTAMP '2024-06-01' ELSE t.record_created_at END AS record_created_at, CASE WHEN {hit} THEN TIMESTAMP '2024-06-01' ELSE t.record_updated_at END AS record_updated_at, CASE WHEN {hit} THEN 'B1' ELSE t.source_load_batch_id END AS source_load_batch_id"


def _merge_sql(label: str) -> str:
    k = "b.o_orderkey % 10"
    put, cut = f"({k} IN (0, 1, 3))", f"({k} = 2)"
    op = f"CASE WHEN {put} AND t.o_orderkey IS NULL THEN 'INSERT' WHEN {k} IN (0, 1) THEN 'UPDATE' WHEN {k} = 3 THEN '{label}' WHEN {cut} THEN 'DELETE' ELSE t.cdc_operation END"
    return f"WITH {B}, b AS (SELECT * FROM base WHERE o_orderkey % 10 < 4) " + MERGED.format(put=put, cut=cut, hit=f"({k} < 4)", op=op, price=f"CASE WHEN {k} < 2 THEN CAST(b.price + 1 AS DECIMAL(18,2)) ELSE b.price END") + f" FROM target t FULL JOIN b ON t.o_orderkey = b.o_orderkey WHERE t.o_orderkey IS NOT NULL OR {put}"


@query(_merge_sql("INSERT"))
def cdc_merge(spark, sf):
    return cdc.cdc_merge(_target(spark, sf), _batch(spark, sf), ["o_orderkey"], as_of(), "B1")


@query(_merge_sql("DUPLICATE_RESOLVED"))
def cdc_merge_duplicate_marker(spark, sf):
    return cdc.cdc_merge(_target(spark, sf), _batch(spark, sf), ["o_orderkey"], as_of(), "B1", "DUPLICATE_RESOLVED")


RELOAD = MERGED.format(put="true", cut="false", hit="true", op="CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'RELOADED' END", price="b.price")


@query(f"WITH {B}, b AS (SELECT * FROM base) {RELOAD} FROM b LEFT JOIN target t ON t.o_orderkey = b.o_orderkey")
def cdc_recovery_merge(spark, sf):
    return cdc.cdc_recovery_merge(_target(spark, sf), _base(spark, sf), ["o_orderkey"], as_of(), "B1")


@query(f"WITH {B} SELECT * FROM target UNION ALL SELECT *, 'INSERT', TIMESTAMP '2024-06-01', false, TIMESTAMP '2024-06-01', TIMESTAMP '2024-06-01', 'B1' FROM base WHERE o_orderkey % 7 = 0")
def cdc_recovery_differential(spark, sf):
    return cdc.cdc_recovery_merge(_target(spark, sf), _base(spark, sf), ["o_orderkey"], as_of(), "B1", True)


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def cdc_dedup_latest(spark, sf):
    return cdc.cdc_dedup(scan(spark, sf, "events"), ["user_id"], [F.desc_nulls_last("ts"), F.desc("event_id")])


_EVENT_BATCH = "SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS cdc_action, event_type IN ('view', 'click') AS cdc_is_update FROM events"


def _event_batch(spark, sf):
    return spark.sql(_EVENT_BATCH.replace("FROM events", "FROM {events}"), events=scan(spark, sf, "events"))


@query(f"SELECT * FROM ({_EVENT_BATCH}) QUALIFY row_number() OVER (PARTITION BY user_id, cdc_action, cdc_is_update ORDER BY ts DESC, event_id DESC) = 1")
def cdc_dedup_by_action(spark, sf):
    return cdc.cdc_dedup(_event_batch(spark, sf), ["user_id"], [F.desc("ts"), F.desc("event_id")], "by_action")


@query(f"SELECT * FROM ({_EVENT_BATCH}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY cdc_action = 'DELETE', ts DESC, event_id DESC) = 1")
def cdc_dedup_insert_priority(spark, sf):
    return cdc.cdc_dedup(_event_batch(spark, sf), ["user_id"], [F.desc("ts"), F.desc("event_id")], "insert_priority")


@query("WITH l AS (SELECT user_id, ts, event_id, value, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events), a AS (SELECT user_id, arg_min(op, (ts, event_id)) AS f, arg_max(op, (ts, event_id)) AS z, max((ts, event_id)) AS m FROM l GROUP BY user_id) SELECT a.user_id, l.ts, l.event_id, l.value, CASE WHEN z = 'D' THEN 'DELETE' ELSE 'INSERT' END AS cdc_action, z <> 'D' AND f <> 'I' AS cdc_is_update FROM a JOIN l ON l.user_id = a.user_id AND (l.ts, l.event_id) = a.m WHERE NOT (f = 'I' AND z = 'D')")
def cdc_coalesce(spark, sf):
    log = scan(spark, sf, "events").selectExpr("user_id", "ts", "event_id", "value", "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op")
    return cdc.cdc_coalesce(log, ["user_id"], ["ts", "event_id"], "op")


@query(f"SELECT count(*) FILTER (cdc_action = 'INSERT' AND NOT cdc_is_update) AS n_insert, count(*) FILTER (cdc_action = 'INSERT' AND cdc_is_update) AS n_update, count(*) FILTER (cdc_action = 'DELETE' AND NOT cdc_is_update) AS n_delete FROM ({_EVENT_BATCH})")
def cdc_pre_metrics(spark, sf):
    return cdc.cdc_pre_metrics(_event_batch(spark, sf))


@query(f"WITH {B} SELECT count(*) AS n_duplicates FROM target WHERE o_orderkey % 10 = 3")
def cdc_duplicate_detect(spark, sf):
    return cdc.cdc_duplicate_detect(_batch(spark, sf), _target(spark, sf), ["o_orderkey"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0")
def detect_soft_deletes(spark, sf):
    return cdc.detect_soft_deletes(_target(spark, sf), _base(spark, sf).where("o_orderkey % 5 <> 0"), ["o_orderkey"])


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def watermark_incremental(spark, sf):
    return cdc.watermark_incremental(scan(spark, sf, "events"), "ts", F.lit("2024-01-10").cast("timestamp_ntz"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_mktsegment IS NULL")
def purge_filter(spark, sf):
    return cdc.purge_filter(scan(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_mktsegment", ["BUILDING", "MACHINERY"])


# --- history over events ---
_V = "SELECT user_id, event_id, ts, event_type, value FROM events"
_H = "SELECT user_id, event_type, row_number() OVER w AS version, ts AS effective_from, coalesce(lead(ts) OVER w - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 23:59:59') AS effective_to, lead(ts) OVER w IS NULL AS is_current, event_type = 'error' AS is_deleted, md5(concat_ws('~', event_type, CAST(event_id AS VARCHAR))) AS attr_hash, md5(CAST(user_id AS VARCHAR) || '~' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS scd_key, event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


def _history(spark, sf):
    e = scan(spark, sf, "events")
    return history.scd2_history(e, "user_id", ["event_type", "event_id"], "ts", ["event_id"], F.col("event_type") == "error")


@query(_H)
def scd2_history(spark, sf):
    return _history(spark, sf)


@query(f"SELECT * FROM ({_H}) WHERE is_current")
def scd2_current_view(spark, sf):
    return history.scd2_current_view(_history(spark, sf))


@query(f"SELECT * FROM ({_H}) WHERE TIMESTAMP '2024-01-15 12:00:00' BETWEEN effective_from AND effective_to")
def scd2_as_of(spark, sf):
    return history.scd2_as_of(_history(spark, sf), "2024-01-15 12:00:00")


@query("SELECT c_custkey, c_mktsegment, TIMESTAMP '2024-01-01' AS effective_from, CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-05-31 23:59:59' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS effective_to, c_custkey % 5 <> 0 AS is_current FROM customer WHERE c_custkey % 11 <> 0 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NEW' ELSE c_mktsegment END, TIMESTAMP '2024-06-01', TIMESTAMP '9999-12-31 23:59:59', true FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 11 = 0")
def scd2_close_and_insert(spark, sf):
    c = scan(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    cur = c.where("c_custkey % 11 <> 0").withColumns({"effective_from": ts("2024-01-01"), "effective_to": ts(history.OPEN_END), "is_current": F.lit(True)})
    inc = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "NEW").otherwise(F.col("c_mktsegment")))
    return history.scd2_close_and_insert(cur, inc, ["c_custkey"], ["c_mktsegment"], as_of())


@query("WITH u AS (SELECT c_custkey AS k, c_mktsegment AS v, TIMESTAMP '2000-01-01' AS eff, 0 AS id FROM customer UNION ALL SELECT user_id, event_type, ts, event_id FROM events) SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY eff DESC, id DESC) = 1")
def current_state(spark, sf):
    snap = scan(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"), F.lit("2000-01-01").cast("timestamp_ntz").alias("eff"), F.lit(0).cast("long").alias("id"))
    return history.current_state(snap, scan(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("v"), F.col("ts").alias("eff"), F.col("event_id").alias("id")), ["k"], [F.desc("eff"), F.desc("id")])


_LOG = "SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS k_old, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k_new, CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS v_old, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS v_new, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op_code, ts AS op_last_replicated, event_id FROM {events}"
_LOG_D = _LOG.replace("{events}", "events")


@query(f"SELECT coalesce(k_new, k_old) AS k, coalesce(v_new, v_old) AS v, op_code = 'D' AS is_deleted, op_last_replicated FROM ({_LOG_D})")
def log_to_current_row(spark, sf):
    return history.log_to_current_row(spark.sql(_LOG, events=scan(spark, sf, "events")), ["k", "v"])


@query(f"WITH l AS ({_LOG_D}), b AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer), r AS (SELECT *, rank() OVER (PARTITION BY k_old ORDER BY event_id DESC) AS n FROM l) SELECT k, v, CAST(NULL AS VARCHAR) AS op FROM b WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.k_old IS NOT DISTINCT FROM b.k) UNION ALL SELECT k_new, v_new, 'NULL' FROM r WHERE n = 1 AND op_code <> 'D' UNION ALL SELECT k_old, v_old, 'D' FROM l WHERE op_code = 'D'")
def net_delta_view(spark, sf):
    base = scan(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return history.net_delta_view(base, spark.sql(_LOG, events=scan(spark, sf, "events")), "k", ["v"], "event_id")


@query("SELECT c_custkey, md5(concat_ws('~', coalesce(c_name, ''), coalesce(c_mktsegment, ''))) AS row_hash FROM customer")
def row_hash(spark, sf):
    return scan(spark, sf, "customer").select("c_custkey", cdc.row_hash(["c_name", "c_mktsegment"]).alias("row_hash"))


# --- movement over events: purchases as events, views as changes ---


@query("WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts AS t, event_id AS id FROM events WHERE event_type = 'view'), f AS (SELECT user_id, arg_min(id, (t, -id)) AS id FROM v GROUP BY user_id) SELECT p.user_id, p.event_id, p.ts, coalesce((SELECT max(id) FROM v WHERE v.user_id = p.user_id AND v.t <= p.ts), f.id) AS matched_id FROM p JOIN f ON f.user_id = p.user_id")
def asof_consist_match(spark, sf):
    e = scan(spark, sf, "events")
    views = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("id"))
    return movement.asof_match(e.where("event_type = 'purchase'"), views, ["user_id"], "event_id", "ts", "t", ["id"])


_LEGS = "SELECT event_id, user_id, event_type, ts, lag(ts) OVER w AS from_ts, lag(event_type) OVER w AS from_event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY from_ts IS NOT NULL"


def _legs(spark, sf):
    return movement.movement_legs(scan(spark, sf, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id"], "ts", "event_id", ["event_type"])


@query("WITH v AS (SELECT event_id, user_id, event_type, ts, lag(ts) OVER w AS from_ts FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY from_ts IS NOT NULL) SELECT event_id, user_id, ts, from_ts FROM v WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = v.user_id AND e.ts BETWEEN v.from_ts AND v.ts AND e.event_type <> v.event_type)")
def anti_conflicting_train(spark, sf):
    e = scan(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    legs = movement.movement_legs(e.where("event_type = 'view'"), ["user_id"], "ts", "event_id", [])
    return movement.anti_conflicting(legs, e, ["user_id"], "from_ts", "ts", "ts", ("event_type", "event_type"), "event_id").select("event_id", "user_id", "ts", "from_ts")


@query("WITH z AS (SELECT event_id, ts, ['PT', 'MT', 'CT', 'ET', 'ST', 'XX'][CAST(user_id % 6 AS INTEGER) + 1] AS zone, CAST(date_trunc('year', ts) AS DATE) AS y FROM events), b AS (SELECT *, (make_date(year(y), 3, 1) + CAST((7 - dayofweek(make_date(year(y), 3, 1))) % 7 + 7 AS INTEGER)) + INTERVAL 5 HOUR AS a, (make_date(year(y), 11, 1) + CAST((7 - dayofweek(make_date(year(y), 11, 1))) % 7 AS INTEGER)) + INTERVAL 4 HOUR AS o FROM z) SELECT event_id, zone, ts + CASE zone WHEN 'ST' THEN -1 WHEN 'PT' THEN CASE WHEN ts BETWEEN a AND o THEN -2 ELSE -3 END WHEN 'MT' THEN CASE WHEN ts BETWEEN a AND o THEN -1 ELSE -2 END WHEN 'CT' THEN CASE WHEN ts BETWEEN a AND o THEN 0 ELSE -1 END WHEN 'ET' THEN CASE WHEN ts BETWEEN a AND o THEN 1 ELSE 0 END END * INTERVAL 1 HOUR AS local_ts FROM b")
def dst_local_time(spark, sf):
    zone = F.element_at(F.array(*map(F.lit, ("PT", "MT", "CT", "ET", "ST", "XX"))), (F.col("user_id") % 6 + 1).cast("int"))
    return scan(spark, sf, "events").select("event_id", zone.alias("zone"), movement.dst_local_time(F.col("ts"), zone).alias("local_ts"))


@query("SELECT o_orderkey, date_diff('month', o_orderdate, TIMESTAMP '2024-06-01') AS months, date_diff('year', o_orderdate, TIMESTAMP '2024-06-01') AS years FROM orders")
def date_diff_boundary(spark, sf):
    d = lambda u: movement.diff_boundary(u, F.col("o_orderdate"), as_of())
    return scan(spark, sf, "orders").select("o_orderkey", d("month").alias("months"), d("year").alias("years"))


# --- quality and reconciliation ---


@query("SELECT count(*) FILTER (value IS NULL) AS null_count, count(value) - count(DISTINCT value) AS duplicate_count, count(*) FILTER (value < 0) AS negative_count FROM events")
def dq_null_count(spark, sf):
    return quality.column_metrics(scan(spark, sf, "events"), "value")




@query("SELECT count(*) AS orphan_count FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0)")
def dq_orphan_count(spark, sf):
    return quality.orphan_count(scan(spark, sf, "lineitem"), scan(spark, sf, "orders").where("o_orderkey % 9 <> 0"), "l_orderkey", "o_orderkey")


@query("SELECT sum(n) AS total_rows, count(*) AS unique_keys, sum(n) - count(*) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def duplicate_key_report(spark, sf):
    return quality.duplicate_key_report(scan(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey, c_acctbal <= 0 AS missing_balance, c_mktsegment = 'BUILDING' AS missing_segment, (CASE WHEN c_acctbal > 0 THEN 0.5 ELSE 0 END + CASE WHEN c_mktsegment <> 'BUILDING' THEN 0.5 ELSE 0 END)::DOUBLE AS quality_score FROM customer")
def dq_quality_score(spark, sf):
    c = scan(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return quality.quality_score(c, {"balance": F.col("c_acctbal") > 0, "segment": F.col("c_mktsegment") != "BUILDING"}).drop("c_acctbal", "c_mktsegment")


@query("SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey < 5 THEN 'low' ELSE '' END AS flags FROM customer WHERE c_acctbal > 0")
def dq_field_rules(spark, sf):
    c = scan(spark, sf, "customer")
    good, _ = quality.field_rules(c, [("positive", F.col("c_acctbal") > 0, "reject"), ("segment", F.col("c_mktsegment") != "BUILDING", "null:c_mktsegment"), ("low", F.col("c_nationkey") >= 5, "flag")])
    return good.select("c_custkey", "c_acctbal", "c_mktsegment", F.array_join("flags", ",").alias("flags"))


def _mutated(spark, sf):
    return scan(spark, sf, "orders").where("o_orderkey % 100 <> 1").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 75 == 0, "X").otherwise(F.col("o_orderstatus")))


@query("SELECT o_orderkey, '<row>' AS column_name, 'present' AS source_value, NULL AS target_value FROM orders WHERE o_orderkey % 100 = 1 UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus, 'X' FROM orders WHERE o_orderkey % 75 = 0 AND o_orderkey % 100 <> 1")
def recon_row_diff(spark, sf):
    return quality.row_diff(scan(spark, sf, "orders"), _mutated(spark, sf), ["o_orderkey"], tolerance=2.0)


@query("SELECT count(*) AS source_rows, count(*) FILTER (o_orderkey % 100 <> 1) AS target_rows, count(*) FILTER (o_orderkey % 100 <> 1) - count(*) AS difference FROM orders")
def recon_count(spark, sf):
    return quality.recon_count(scan(spark, sf, "orders"), _mutated(spark, sf))


@query("SELECT 'o_orderkey' AS column_name, sum(o_orderkey)::DOUBLE AS sum_value, min(o_orderkey)::DOUBLE AS min_value, max(o_orderkey)::DOUBLE AS max_value, count(DISTINCT o_orderkey) AS distinct_value FROM orders UNION ALL SELECT 'o_totalprice', sum(o_totalprice::DECIMAL(30,2))::DOUBLE, min(o_totalprice), max(o_totalprice), count(DISTINCT o_totalprice) FROM orders")
def recon_aggregate(spark, sf):
    return quality.recon_aggregate(scan(spark, sf, "orders"), ["o_orderkey", "o_totalprice"])


@query()
def recon_hash(spark, sf):
    return quality.recon_hash(scan(spark, sf, "orders"))


# --- governance ---


@query("SELECT c_custkey, '*** ***' AS c_name, round(c_acctbal, -4) + 0.0::DOUBLE AS c_acctbal, repeat('*', length(c_mktsegment)) AS c_mktsegment FROM customer")
def mask_columns(spark, sf):
    rows = scan(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return governance.mask(rows, "DATA_ANALYST", {"c_name": "name", "c_acctbal": "financial_amount", "c_mktsegment": "pii_generic"})


@query("SELECT c_custkey, sha256(c_name) AS c_name FROM customer")
def mask_hash(spark, sf):
    return governance.mask(scan(spark, sf, "customer").select("c_custkey", "c_name"), "ANALYST", {"c_name": "hash"})


@query("SELECT 'orders' AS table_name, count(*) AS rows_before, count(*) FILTER (o_orderdate < TIMESTAMP '2024-06-01' - INTERVAL 9000 DAY) AS rows_deleted, count(*) FILTER (o_orderdate >= TIMESTAMP '2024-06-01' - INTERVAL 9000 DAY) AS rows_after, 'SUCCESS' AS status FROM orders")
def retention_dry_run(spark, sf):
    return governance.retention_log(scan(spark, sf, "orders"), "orders", "o_orderdate", 9000, as_of())


# --- plain relational forms: one text for both engines ---
_REV = "CAST(CAST({p} AS DECIMAL(18,2)) AS DECIMAL(18,2))"
both("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F'")
both("silver_lineitem_net", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) * CAST(1 + l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS net_amount FROM {lineitem}")
both("incremental_window_filter", "SELECT event_id, ts FROM {events} WHERE ts >= TIMESTAMP_NTZ '2024-01-05' AND ts < TIMESTAMP_NTZ '2024-01-12'", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
both("lookback_window_filter", "SELECT event_id, ts FROM {events} WHERE ts >= TIMESTAMP_NTZ '2024-01-20' - INTERVAL 10 DAY", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 10 DAY")
both("event_code_filter", "SELECT event_id, event_type FROM {events} WHERE event_type IN ('view', 'click') AND event_type <> 'error'")
both("conditional_decode", "SELECT event_id, CASE WHEN event_type = 'view' THEN user_id WHEN event_type = 'click' THEN -1 ELSE -2 END AS place FROM {events}")
both("null_default", "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS segment, coalesce(nullif(c_nationkey, 3), -999999) AS nation FROM {customer}")
both("null_safe_equal", "SELECT o.o_orderkey, m.n FROM {orders} o JOIN (SELECT nullif(o_orderstatus, 'P') AS s, count(*) AS n FROM {orders} GROUP BY 1) m ON nullif(o.o_orderstatus, 'P') IS NOT DISTINCT FROM m.s")
both("ilike_predicate", "SELECT p_partkey, p_name FROM {part} WHERE p_name ILIKE '%WIDGET%'")
both("case_bucket", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'GOLD' WHEN c_acctbal > 1000 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM {customer}")
both("country_state_standardize", "SELECT c_custkey, CASE WHEN upper(n_name) IN ('UNITED STATES', 'USA', 'US') THEN 'US' WHEN upper(n_name) IN ('UNITED KINGDOM', 'UK') THEN 'GB' ELSE upper(n_name) END AS country FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
both("code_mapping", "SELECT o.o_orderkey, m.std FROM {orders} o LEFT JOIN (VALUES ('F', 'FINISHED'), ('O', 'OPEN')) AS m(code, std) ON o.o_orderstatus = m.code")
both("values_table", "SELECT m.code, m.std, count(o_orderkey) AS n FROM (VALUES ('F', 'FINISHED'), ('O', 'OPEN'), ('Z', 'NONE')) AS m(code, std) LEFT JOIN {orders} ON o_orderstatus = m.code GROUP BY m.code, m.std")
both("range_validate", "SELECT event_id, CASE WHEN value BETWEEN 1 AND 50 THEN value END AS value FROM {events}")
both("gold_customer_orders", "SELECT o_orderkey, o_orderdate, o_totalprice, c_name, n_name, r_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey")
both("gold_order_line_details", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, s_name, n_name, datediff(l_shipdate, o_orderdate) AS variance_days FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, s_name, n_name, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS variance_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
GOLD = "SELECT c_custkey, c_name, n_name, count(o_orderkey) AS n_orders, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS spend, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_finished, CASE WHEN coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) > 3000000 THEN 'PLATINUM' WHEN coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) > 1000000 THEN 'GOLD' ELSE 'STANDARD' END AS tier FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey, c_name, n_name"
both("gold_customer_metrics", GOLD)
both("left_enrich", "SELECT o_orderkey, c_name FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey AND c_acctbal > 0")
both("star_join_with_optional_dim", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name, c_name FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey LEFT JOIN {orders} ON l_orderkey = o_orderkey LEFT JOIN {customer} ON o_custkey = c_custkey")
both("anti_join_not_exists", "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey)")
both("semi_join_exists", "SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
both("semi_join_in", "SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')")
both("self_join_tags", "SELECT a.user_id, a.event_id AS view_id, b.event_id AS buy_id FROM {events} a LEFT JOIN {events} b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.value = a.value WHERE a.event_type = 'view'")
both("scalar_subquery_latest", "SELECT event_id, user_id FROM {events} WHERE ts = (SELECT max(ts) FROM {events})")
both("fact_daily_sales", "SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {lineitem} GROUP BY 1, 2")
both("monthly_by_customer", "SELECT o_custkey, date_trunc('month', o_orderdate) AS month, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {orders} GROUP BY 1, 2")
both("churn_features", "SELECT o_custkey, count(*) AS frequency, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value, count(DISTINCT o_orderpriority) AS diversity, round(stddev(o_totalprice), 2) AS std_value FROM {orders} GROUP BY 1")
both("rollup_sums_by_rule", "SELECT 'by_status' AS rule, o_orderstatus AS grp, count(*) AS n FROM {orders} GROUP BY 2 UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM {orders} GROUP BY 2")
both("count_distinct_concat", "SELECT count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS n FROM {lineitem}")
both("count_if", "SELECT o_custkey, count_if(o_orderstatus = 'F') AS f, count_if(o_orderstatus = 'O') AS o FROM {orders} GROUP BY o_custkey")
both("listagg_distinct", "SELECT o_custkey, array_join(array_sort(collect_set(o_orderstatus)), ',') AS statuses FROM {orders} GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1", "SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
both("max_by_latest", "SELECT user_id, max_by(event_type, struct(ts, event_id)) AS last_type FROM {events} GROUP BY user_id", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id")
both("mode_value", "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM (SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY 1, 2) c) m WHERE r = 1")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def percentile_cont(spark, sf):
    """From the counts of each value, so that no group's values meet in one row."""
    counts = scan(spark, sf, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    found = monitoring.percentiles(counts, ["event_type"], "value", "n", {"p50": 0.5, "p95": 0.95})
    return found.select("event_type", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


both("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM {orders}")
both("having_filter", "SELECT user_id, count(*) AS n FROM {events} WHERE event_type = 'error' GROUP BY user_id HAVING count(*) > 5")
both(
    "brute_force_24h",
    "SELECT user_id, count(*) AS failed_attempts, min(ts) AS first_attempt, max(ts) AS last_attempt FROM {events} WHERE event_type = 'error' AND ts > (SELECT max(ts) FROM {events}) - INTERVAL 24 HOURS GROUP BY user_id HAVING count(*) > 5",
)
both("group_by_all", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY ALL")
both("group_by_ordinal", "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1")
both("pct_of_total", "SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM {orders} GROUP BY o_orderstatus")
both("latest_waybill", "SELECT event_id, user_id, ts FROM (SELECT event_id, user_id, ts, max(ts) OVER (PARTITION BY user_id) AS m FROM {events} WHERE event_type = 'view') x WHERE ts = m")
both("latest_by_rank", "SELECT user_id, event_id FROM (SELECT user_id, event_id, rank() OVER (PARTITION BY user_id ORDER BY value DESC) AS r FROM {events}) x WHERE r = 1")
both("latest_by_row_number", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM {events}) x WHERE r = 1")
both("reverse_row_number", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM {events}")
both("max_over_partition", "SELECT event_id, max(value) OVER (PARTITION BY user_id) AS most, min(value) OVER (PARTITION BY user_id) AS least FROM {events}")
both("count_over_partition", "SELECT event_id, count(*) OVER (PARTITION BY user_id) AS n FROM {events}")
both("order_by_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS severity FROM {orders} ORDER BY severity, o_orderkey")
both("order_nulls_last", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS r FROM {orders} ORDER BY r DESC NULLS LAST, o_orderkey")
both("top_k", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
both("union_all_branches", "SELECT event_id, 'v' AS k FROM {events} WHERE event_type = 'view' UNION ALL SELECT event_id, 'c' FROM {events} WHERE event_type = 'click' UNION ALL SELECT event_id, 'p' FROM {events} WHERE event_type = 'purchase'")
both("union_all_metrics", "SELECT 'orders' AS metric, count(*) AS n FROM {orders} UNION ALL SELECT 'lines', count(*) FROM {lineitem} UNION ALL SELECT 'customers', count(*) FROM {customer}")
both("route_and_union", "SELECT event_id, value * 2 AS v FROM {events} WHERE value > 20 UNION ALL SELECT event_id, value AS v FROM {events} WHERE NOT coalesce(value > 20, false)")
both("string_clean", "SELECT c_custkey, upper(trim(c_name)) AS up, lower(c_name) AS low, substr(c_name, 1, 3) AS head, length(c_name) AS n, right(c_name, 4) AS tail FROM {customer}")
both("safe_convert", "SELECT event_id, try_cast(event_type AS INT) AS n, try_cast(CAST(user_id AS STRING) AS INT) AS u FROM {events}")
both("json_extract", "SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
both("fiscal_year", "SELECT o_orderkey, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS fiscal_year FROM {orders}")
both("email_validate", "SELECT doc_id, regexp_like(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z][A-Za-z]+') AS has_email FROM {documents}", "SELECT doc_id, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z][A-Za-z]+') AS has_email FROM documents")
both("phone_format", "SELECT c_custkey, concat('(', substr(d, 1, 3), ') ', substr(d, 4, 3), '-', substr(d, 7, 4)) AS phone FROM (SELECT c_custkey, right(concat('5550000000', regexp_replace(c_name, '[^0-9]', '')), 10) AS d FROM {customer}) x", "SELECT c_custkey, concat('(', substr(d, 1, 3), ') ', substr(d, 4, 3), '-', substr(d, 7, 4)) AS phone FROM (SELECT c_custkey, right(concat('5550000000', regexp_replace(c_name, '[^0-9]', '', 'g')), 10) AS d FROM customer) x")
both("dq_cross_field", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount <= l_tax THEN 'ok' ELSE 'discount above tax' END AS verdict FROM {lineitem}")
both("dq_accepted_values", "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus")
both("dq_accepted_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem} WHERE l_quantity NOT BETWEEN 5 AND 45")
both("dq_freshness_hours", "SELECT timestampdiff(HOUR, date_trunc('hour', max(ts)), TIMESTAMP_NTZ '2024-06-01') AS hours FROM {events}", "SELECT date_diff('hour', max(ts), TIMESTAMP '2024-06-01') AS hours FROM events")
# With the windows of the reference, back from the log's last time; an event's value stands for its seconds.
both(
    "execution_stats_last_24h",
    "SELECT date_trunc('hour', ts) AS hour, count(*) AS runs, count_if(event_type = 'error') AS failed, round(avg(value), 6) AS mean_seconds, max(value) AS most_seconds FROM {events} WHERE ts >= (SELECT max(ts) FROM {events}) - INTERVAL 24 HOURS GROUP BY 1",
)
both(
    "pipeline_trend_last_7d",
    "SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS runs, count_if(event_type = 'error') AS failed, round(avg(value), 6) AS mean_value FROM {events} WHERE ts >= (SELECT max(ts) FROM {events}) - INTERVAL 7 DAYS GROUP BY 1, 2",
)


#: Lines as the cars and locomotives of a train, which is their order.
_CARS = "SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'LD' WHEN 2 THEN 'LT' WHEN 3 THEN 'DH' ELSE 'NA' END AS role, CASE WHEN l_linenumber < 4 THEN l_partkey END AS locomotive_id, CASE WHEN p_size = 1 THEN 'EOTD' END AS group_code, CASE p_size % 5 WHEN 0 THEN 'M930' WHEN 1 THEN 'M120' WHEN 2 THEN 'M530' WHEN 3 THEN 'D10' ELSE 'X40' END AS car_code, CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END AS content_tons, CASE WHEN p_size > 3 THEN 30 END AS tare_tons, CASE WHEN l_linenumber < 4 THEN p_size * 2000 END AS full_weight, CASE WHEN l_linenumber < 4 THEN p_size * 100 END AS horsepower, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey % 500 END AS miles, CASE WHEN l_linenumber > 3 THEN p_size * 12 END AS car_inches, CASE WHEN l_linenumber < 4 THEN p_size * 24 END AS loco_inches FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey"
_CARS_SQL = _CARS.replace("{lineitem}", "lineitem").replace("{part}", "part")


@query(f"WITH cars AS ({_CARS_SQL}) SELECT l_orderkey, count(*) FILTER (coalesce(locomotive_id, 0) > 0 AND coalesce(group_code, '') <> 'EOTD') AS live_unit, count(*) FILTER (content_tons > 0) AS cars_loaded, count(*) FILTER (role = 'NA') AS cars_total, count(locomotive_id) FILTER (role IN ('LD', 'LT')) AS live_loco_count, count(locomotive_id) FILTER (role = 'DH') AS dh_loco_count, coalesce(sum(miles) FILTER (role = 'NA'), 0)::DOUBLE AS eqpmt_miles, coalesce(sum(miles) FILTER (role = 'LD'), 0)::DOUBLE AS train_miles, coalesce(sum(miles) FILTER (role IN ('LD', 'LT')), 0)::DOUBLE AS live_loco_miles, coalesce(sum(miles) FILTER (role = 'DH'), 0)::DOUBLE AS dh_loco_miles, coalesce(sum(miles) FILTER (role = 'NA' AND substr(car_code, 1, 1) NOT IN ('M', 'D') AND content_tons > 0), 0)::DOUBLE AS rev_car_miles_loaded, coalesce(sum(miles) FILTER (role = 'NA' AND substr(car_code, 1, 1) NOT IN ('M', 'D') AND content_tons = 0), 0)::DOUBLE AS rev_car_miles_empty, coalesce(sum(miles) FILTER (substr(car_code, 1, 2) = 'M5'), 0)::DOUBLE AS pass_bus_miles, coalesce(sum(miles) FILTER (car_code >= 'M100' AND car_code <= 'M4999'), 0)::DOUBLE AS work_car_miles, coalesce(sum(miles) FILTER (car_code = 'M930'), 0)::DOUBLE AS caboose_miles, coalesce(sum(horsepower), 0)::DOUBLE AS sum_hrspwr_qty, coalesce(sum(horsepower * miles) FILTER (role IN ('LD', 'LT')), 0)::DOUBLE AS live_loco_hp_miles, coalesce(sum(horsepower * miles) FILTER (role = 'DH'), 0)::DOUBLE AS dh_loco_hp_miles, coalesce(sum(full_weight / 2000), 0)::DOUBLE AS loco_full_weight, coalesce(sum(coalesce(full_weight / 2000, tare_tons, 0)), 0)::DOUBLE AS tare_tons, coalesce(sum(coalesce(full_weight / 2000, tare_tons, 0) * coalesce(miles, 0)) FILTER (role = 'NA'), 0)::DOUBLE AS tare_ton_miles, coalesce(sum(coalesce(full_weight / 2000, tare_tons, 0) * coalesce(miles, 0)) FILTER (role IN ('LD', 'LT')), 0)::DOUBLE AS loco_tare_ton_miles, coalesce(sum(coalesce(full_weight / 2000, tare_tons, 0) * coalesce(miles, 0)) FILTER (role = 'DH'), 0)::DOUBLE AS dh_tare_ton_miles, coalesce(sum(content_tons * coalesce(miles, 0)), 0)::DOUBLE AS content_ton_miles, coalesce(sum(loco_inches / 12.0 * coalesce(miles, 0)) FILTER (role IN ('LD', 'LT')), 0)::DOUBLE AS live_loco_foot_miles, coalesce(sum(loco_inches / 12.0 * coalesce(miles, 0)) FILTER (role = 'DH'), 0)::DOUBLE AS dh_loco_foot_miles, coalesce(sum(car_inches), 0)::DOUBLE / 12 AS car_length_feet, coalesce(sum(loco_inches), 0)::DOUBLE / 12 AS loco_foot_miles FROM cars GROUP BY l_orderkey")
def train_level_summary(spark, sf):
    cars = spark.sql(_CARS, lineitem=scan(spark, sf, "lineitem"), part=scan(spark, sf, "part"))
    return movement.train_level_summary(cars, ["l_orderkey"])


# Two levels of arrays, flattened: an order's lines, and each line's words.
both(
    "flatten_nested",
    "SELECT o_orderkey, line.n AS line, word FROM (SELECT l_orderkey AS o_orderkey, collect_list(named_struct('n', l_linenumber, 'words', array(l_returnflag, l_linestatus))) AS lines FROM {lineitem} GROUP BY l_orderkey) LATERAL VIEW explode(lines) a AS line LATERAL VIEW explode(line.words) b AS word",
    "SELECT l_orderkey AS o_orderkey, l_linenumber AS line, unnest([l_returnflag, l_linestatus]) AS word FROM lineitem",
)


# --- the other families ---
for _r in (table_queries.R, movement_queries.R, monitoring_queries.R, audit_queries.R):
    if _twice := QUERIES.keys() & _r.queries.keys():
        raise ValueError(f"registered twice: {sorted(_twice)}")
    QUERIES.update(_r.queries)
    ORACLES.update(_r.oracles)
