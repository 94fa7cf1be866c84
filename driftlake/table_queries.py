"""Config-driven merges, history, sources and sinks, streams, movement, sales and reconciliation over the test tables."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from driftlake.operators import cdc, history, movement, quality, sales, text
from driftlake.registry import Registry
from driftlake.sources import tables as io
from driftlake.sources.dated import DatedTable, drop_old_copies, retention_configs, retention_run
from driftlake.sources.manifests import LoadedTable
from driftlake.sources.tables import scan
from driftlake.sources.versioned import VersionedTable
from driftlake.streaming import apply as streams

R = Registry()
AS_OF = "2024-06-01 00:00:00"


def add(oracle: str | None):
    def to(f):
        R.add(f.__name__, f, oracle)
        return f

    return to


def _at(text: str = AS_OF):
    return F.lit(text).cast("timestamp_ntz")


# --- merges: orders as the source; every seventh isn't in the target yet ---
_SRC = "src AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate FROM orders)"
_OLD = _SRC + ", t AS (SELECT *, 'INSERT' AS cdc_operation, TIMESTAMP '2024-01-01' AS cdc_timestamp, false AS is_deleted, TIMESTAMP '2024-01-01' AS record_created_at, TIMESTAMP '2024-01-01' AS record_updated_at, 'B0' AS source_load_batch_id FROM src WHERE o_orderkey % 7 <> 0)"


def _source(spark, sf):
    return scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderdate")


def _target(spark, sf):
    return cdc.new_target(_source(spark, sf).where("o_orderkey % 7 <> 0"), _at("2024-01-01"), "B0")


def _changed(spark, sf):
    """The source with other prices for one order in ten, and without one in thirteen."""
    price = F.when(F.col("o_orderkey") % 10 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    return _source(spark, sf).withColumn("price", price).where("o_orderkey % 13 <> 0")


def _after(hit: str, cut: str = "false", rows: str = "true", batch: str = "B1") -> str:
    """Of target t full join source s: rows that hit are overwritten or added, rows that cut are marked."""
    put = f"(s.o_orderkey IS NOT NULL AND {hit})"
    moved = f"({put} OR {cut})"
    return f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN {put} THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, CASE WHEN {put} THEN s.price ELSE t.price END AS price, CASE WHEN {put} THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate, CASE WHEN {put} AND t.o_orderkey IS NULL THEN 'INSERT' WHEN {put} THEN 'UPDATE' WHEN {cut} THEN 'DELETE' ELSE t.cdc_operation END AS cdc_operation, CASE WHEN {moved} THEN TIMESTAMP '2024-06-01' ELSE t.cdc_timestamp END AS cdc_timestamp, {cut} AS is_deleted, CASE WHEN t.o_orderkey IS NULL THEN TIMESTAMP '2024-06-01' ELSE t.record_created_at END AS record_created_at, CASE WHEN {moved} THEN TIMESTAMP '2024-06-01' ELSE t.record_updated_at END AS record_updated_at, CASE WHEN {moved} THEN '{batch}' ELSE t.source_load_batch_id END AS source_load_batch_id FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey WHERE (t.o_orderkey IS NOT NULL OR {put}) AND {rows}"


_NEW = f"WITH {_OLD}, s AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN CAST(price + 1 AS DECIMAL(18,2)) ELSE price END AS price, o_orderdate FROM src WHERE o_orderkey % 13 <> 0) "


def _sync(spark, sf, mode, **how):
    return cdc.cdc_sync(_target(spark, sf), _changed(spark, sf), ["o_orderkey"], _at(), "B1", mode, **how)


@add(_NEW + _after("true"))
def cdc_mode_full(spark, sf):
    return _sync(spark, sf, "FULL")


@add(_NEW + _after("s.o_orderdate > TIMESTAMP '2000-01-01'"))
def cdc_mode_incremental(spark, sf):
    return _sync(spark, sf, "INCREMENTAL", ts="o_orderdate", watermark=datetime.datetime(2000, 1, 1))


@add(_NEW + _after("true", "(t.o_orderkey IS NOT NULL AND s.o_orderkey IS NULL)"))
def cdc_mode_soft_delete(spark, sf):
    return _sync(spark, sf, "SOFT_DELETE")


def _batch(spark, sf):
    """Updates, deletes, plain inserts and old images by the last digit of the key."""
    k = F.col("o_orderkey") % 10
    b = _source(spark, sf).where(k < 5)
    price = F.when(k < 2, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    return b.withColumns({"price": price, "cdc_action": F.when(k.isin(2, 4), "DELETE").otherwise("INSERT"), "cdc_is_update": (k < 2) | (k == 4), "row_id": F.concat(F.lit("r"), "o_orderkey")})


_CONFIG = {"table": "orders", "keys": ["o_orderkey"], "columns": ["o_orderstatus", "price"], "filter": "o_orderdate >= TIMESTAMP_NTZ '1996-01-01'", "purge_owner": "o_orderstatus", "purged": ["P"], "validate": True}
_K = "s.o_orderkey % 10"
_GEN = f"WITH {_OLD}, s AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 < 2 THEN CAST(price + 1 AS DECIMAL(18,2)) ELSE price END AS price, o_orderdate FROM src WHERE o_orderkey % 10 < 4 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus <> 'P') "


@add(f"SELECT * REPLACE (CASE WHEN cdc_operation = 'UPDATE' AND o_orderkey % 10 = 3 THEN 'INSERT' ELSE cdc_operation END AS cdc_operation, coalesce(is_deleted, false) AS is_deleted, CASE WHEN record_created_at = TIMESTAMP '2024-01-01' THEN o_orderdate END AS o_orderdate) FROM ({_GEN + _after(f'{_K} IN (0, 1, 3)', f'coalesce({_K} = 2, false)')})")
def cdc_generic(spark, sf):
    return cdc.cdc_generic(_target(spark, sf), _batch(spark, sf), _CONFIG, _at(), "B1")


_LOGGED = "log AS (SELECT event_id % 400 AS o_orderkey, event_type AS o_orderstatus, CAST(value AS DECIMAL(18,2)) AS price, ts AS o_orderdate, event_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events), net AS (SELECT o_orderkey, arg_min(op, event_id) AS f, arg_max(op, event_id) AS z, max(event_id) AS e FROM log GROUP BY 1), s AS (SELECT l.o_orderkey, l.o_orderstatus, l.price, l.o_orderdate, n.z = 'D' AS gone, n.f <> 'I' AS known FROM net n JOIN log l ON l.event_id = n.e WHERE NOT (n.f = 'I' AND n.z = 'D'))"


_STAGED = _after("NOT s.gone", "coalesce(s.gone AND t.o_orderkey IS NOT NULL, false)")


@add(f"WITH {_OLD}, {_LOGGED} SELECT x.* REPLACE (CASE WHEN x.cdc_operation = 'UPDATE' AND coalesce(NOT n.known, false) THEN 'INSERT' ELSE x.cdc_operation END AS cdc_operation) FROM ({_STAGED}) x LEFT JOIN s n ON n.o_orderkey = x.o_orderkey")
def cdc_merge_staged(spark, sf):
    log = scan(spark, sf, "events").selectExpr("event_id % 400 AS o_orderkey", "event_type AS o_orderstatus", "CAST(value AS DECIMAL(18,2)) AS price", "ts AS o_orderdate", "event_id", "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op")
    return cdc.cdc_merge_staged(_target(spark, sf), log, ["o_orderkey"], ["event_id"], "op", _at(), "B1")


def _run(spark, sf):
    """Two configs that work, one whose filter fails as it is planned, and one whose keys fail as it runs."""
    configs = [{"table": "orders_b", "keys": ["o_orderkey"], "priority": 2}, {"table": "orders_a", "keys": ["o_orderkey"], "filter": "o_orderkey % 2 = 0", "priority": 1}, {"table": "broken", "keys": ["o_orderkey"], "filter": "nothing > 1", "priority": 3}, {"table": "null_keys", "keys": ["o_orderkey"], "validate": True, "priority": 4, "nulls": True}, {"table": "off", "keys": ["o_orderkey"], "active": False}]

    def run(c):
        batch = _batch(spark, sf)
        batch = batch.withColumn("o_orderkey", F.nullif(F.col("o_orderkey"), F.lit(3))) if c.get("nulls") else batch
        return cdc.cdc_generic(_target(spark, sf), batch, c, _at(), "B1")

    return configs, run, lambda c, df: df.where("source_load_batch_id = 'B1'").count()


def _statuses(spark, rows):
    return spark.createDataFrame([(r["table"], r["status"], r["result"]) for r in rows], "table_name string, status string, n_changed long")


_N = "count(*) FILTER ({0}o_orderkey % 10 IN (0, 1, 3) OR ({0}o_orderkey % 10 = 2 AND o_orderkey % 7 <> 0)) AS n_changed FROM orders"


@add(f"SELECT 'orders_a' AS table_name, 'SUCCESS' AS status, count(*) FILTER (o_orderkey % 2 = 0 AND (o_orderkey % 10 = 0 OR (o_orderkey % 10 = 2 AND o_orderkey % 7 <> 0))) AS n_changed FROM orders UNION ALL SELECT 'orders_b', 'SUCCESS', {_N.format('')} UNION ALL SELECT 'broken', 'ERROR', NULL UNION ALL SELECT 'null_keys', 'ERROR', NULL")
def cdc_process_all(spark, sf):
    return _statuses(spark, cdc.cdc_process_all(*_run(spark, sf)))


@add(f"SELECT 'orders_b' AS table_name, 'SUCCESS' AS status, {_N.format('')} UNION ALL SELECT 'orders_b', 'DRY_RUN', NULL")
def cdc_filtered_run(spark, sf):
    some = cdc.cdc_filtered_run(*_run(spark, sf), pattern="*_b")
    return _statuses(spark, some + cdc.cdc_filtered_run(*_run(spark, sf), pattern="*_b", dry_run=True))


@add("SELECT count(*) FILTER (o_orderkey % 10 < 5) AS n_valid, true AS refused FROM orders")
def cdc_stage_validation(spark, sf):
    n = cdc.stage_validation(_batch(spark, sf), ["o_orderkey"]).count()
    try:
        cdc.stage_validation(_batch(spark, sf).withColumn("o_orderkey", F.nullif(F.col("o_orderkey"), F.lit(3))), ["o_orderkey"]).count()
        refused = False
    except Exception as e:  # noqa: BLE001
        refused = "null in a key" in str(e)
    return spark.createDataFrame([(n, refused)], "n_valid long, refused boolean")


@add("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || '!' ELSE o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 4 = 0 THEN 'new' ELSE 'old' END AS source FROM orders WHERE o_orderkey % 9 <> 1 OR o_orderkey % 4 <> 0")
def merge_hash_changed(spark, sf):
    o = scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = o.where("o_orderkey % 9 <> 1").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority"))).withColumn("source", F.lit("new"))
    return cdc.merge_hash_changed(o.where("o_orderkey % 4 <> 0").withColumn("source", F.lit("old")), new, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@add("SELECT 'events' AS table_name, max(ts) AS watermark FROM events UNION ALL SELECT 'orders', TIMESTAMP '2000-01-01' UNION ALL SELECT 'rows', TIMESTAMP '1970-01-01' + INTERVAL 1 SECOND * (SELECT count(*) FROM events WHERE ts > TIMESTAMP '2024-01-10')")
def watermark_advance(spark, sf):
    marks = spark.sql("SELECT 'events' AS table_name, TIMESTAMP_NTZ '2024-01-10' AS watermark UNION ALL SELECT 'orders', TIMESTAMP_NTZ '2000-01-01'")
    rows, after = cdc.watermark_advance(scan(spark, sf, "events"), "ts", marks, "events")
    n = rows.agg(F.count("*").alias("n")).select(F.lit("rows").alias("table_name"), (_at("1970-01-01") + F.make_dt_interval(secs=F.col("n").cast("decimal(18,6)"))).alias("watermark"))
    return after.unionByName(n)


@add("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'zz' || upper(c_name) ELSE c_name END AS c_name FROM customer")
def config_upsert(spark, sf):
    c = scan(spark, sf, "customer").select("c_custkey", "c_name")
    some = c.where("c_custkey % 5 = 0")
    twice = some.withColumn("c_name", F.upper("c_name")).unionByName(some.withColumn("c_name", F.concat(F.lit("zz"), F.upper("c_name"))))
    return cdc.config_upsert(c, twice, ["c_custkey"])


@add("SELECT * FROM events WHERE event_type = 'view'")
def scan_change_stream(spark, sf):
    return io.scan_change_stream(scan(spark, sf, "events").where("event_type = 'view'"), io.work_dir(spark, "staged"))


@add("SELECT o_orderkey, o_orderstatus, 'INSERT' AS cdc_action, false AS cdc_is_update, md5(CAST(o_orderkey AS VARCHAR)) AS row_id FROM orders")
def scan_initial_snapshot(spark, sf):
    return cdc.initial_snapshot(scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


@add("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS k FROM orders WHERE o_orderstatus <> 'P'")
def null_key_filter(spark, sf):
    return cdc.null_key_filter(scan(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS k"), ["k"])


@add("SELECT * FROM events WHERE event_id > 100")
def scan_log_append_only(spark, sf):
    return io.scan_log_append_only(scan(spark, sf, "events"), "event_id", 100)[0]


# --- history ---
_HASH = "md5(concat_ws('~', coalesce(c_name, ''), coalesce(c_mktsegment, '')))"


@add(f"SELECT md5(CAST(c_custkey AS VARCHAR) || '~2024-01-01 00:00:00.000000') AS scd_key, c_custkey, c_name, c_mktsegment, {_HASH} AS attr_hash, TIMESTAMP '2024-01-01' AS effective_from, TIMESTAMP '9999-12-31 23:59:59' AS effective_to, false AS is_deleted FROM customer")
def scd2_snapshot_rows(spark, sf):
    c = scan(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", _at("2024-01-01").alias("loaded"))
    return history.scd2_snapshot_rows(c, "c_custkey", ["c_name", "c_mktsegment"], "loaded")


_OPLOG = "SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS k_old, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k_new, CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS v_old, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS v_new, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op_code, ts AS op_last_replicated FROM {events}"


@add("SELECT md5(CAST(user_id AS VARCHAR) || '~' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS scd_key, user_id AS k, event_type AS v, md5(event_type) AS attr_hash, ts AS effective_from, TIMESTAMP '9999-12-31 23:59:59' AS effective_to, event_type = 'error' AS is_deleted FROM events")
def scd2_change_rows(spark, sf):
    return history.scd2_change_rows(spark.sql(_OPLOG, events=scan(spark, sf, "events")), "k", ["v"])


@add("SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version, ts AS effective_from FROM events")
def scd2_history_view(spark, sf):
    rows = history.scd2_history(scan(spark, sf, "events"), "user_id", ["event_type", "event_id"], "ts", ["event_id"])
    return history.scd2_history_view(rows, "user_id").select("user_id", "event_type", "version", "effective_from")


@add("SELECT c_custkey, v AS c_mktsegment, f AS effective_from, e AS effective_to, e = TIMESTAMP '9999-12-31 23:59:59' AS is_current FROM (SELECT c_custkey, c_mktsegment AS v, TIMESTAMP '2024-01-01' AS f, CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-05-31 23:59:59' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS e FROM customer WHERE c_custkey % 11 <> 0 UNION ALL SELECT c_custkey, 'NEW', TIMESTAMP '2024-06-01', TIMESTAMP '9999-12-31 23:59:59' FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 11 <> 0 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NEW' ELSE c_mktsegment END, TIMESTAMP '2024-06-01', TIMESTAMP '9999-12-31 23:59:59' FROM customer WHERE c_custkey % 11 = 0) x")
def scd2_merge_close(spark, sf):
    """Changed customers are closed and get a new version, unknown ones start; no change reaches the others."""
    c = scan(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    cur = c.where("c_custkey % 11 <> 0").withColumns({"effective_from": _at("2024-01-01"), "effective_to": _at(history.OPEN_END), "is_current": F.lit(True)})
    inc = c.where("c_custkey % 5 = 0 or c_custkey % 11 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "NEW").otherwise(F.col("c_mktsegment")))
    return history.scd2_close_and_insert(cur, inc, ["c_custkey"], ["c_mktsegment"], _at())


# --- sources and sinks: written to a work folder and read back ---


@add("SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS row_number FROM events")
def load_json_landing(spark, sf):
    """Three files of JSON lines, each with a line that doesn't parse at its end."""
    at = io.work_dir(spark, "landing")
    e = scan(spark, sf, "events").select((F.col("user_id") % 3).alias("part"), "event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("value"))
    bad = spark.range(3).select(F.col("id").alias("part"), F.lit(1 << 60).alias("event_id"), F.lit("{broken").alias("value"))
    for k in range(3):
        e.unionByName(bad).where(F.col("part") == k).coalesce(1).sortWithinPartitions("event_id").select("value").write.mode("append").text(at)
    return io.load_json_landing(spark, at).select(F.variant_get("data", "$.id", "string").alias("id"), F.variant_get("data", "$.kind", "string").alias("kind"), F.col("row_number").cast("long").alias("row_number"))


@add("SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0")
def load_json_continuous(spark, sf):
    """Two calls: the second reads only the files that came between."""
    at, to, check = (io.work_dir(spark, n) for n in ("landing", "loaded", "offsets"))
    lines = scan(spark, sf, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("value"))
    for part in ("event_id % 2 = 0", "event_id % 2 <> 0 and event_id % 3 = 0"):
        lines.where(part).select("value").write.mode("append").text(at)
        io.load_json_continuous(spark, at, to, check).awaitTermination()
    return spark.read.parquet(to).select(F.get_json_object("data", "$.id").alias("id"), F.get_json_object("data", "$.kind").alias("kind"))


@add("SELECT 'customers' AS table_name, count(*) AS n_rows, 3 AS n_columns, 'SUCCESS' AS status FROM customer UNION ALL SELECT 'missing', 0, 0, 'FAILED'")
def load_delimited_batch(spark, sf):
    at = io.work_dir(spark, "sheets")
    scan(spark, sf, "customer").select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("name!")).repartition(3).write.option("header", True).csv(at)
    log = io.load_delimited(spark, {"customers": f"{at}/*.csv", "missing": f"{at}/none/*.csv"}, io.work_dir(spark, "loaded"))
    return log.drop("message")


@add("SELECT c_custkey::VARCHAR AS cust_key, c_name AS name, c_mktsegment AS name_2 FROM customer")
def load_delimited_rows(spark, sf):
    at = io.work_dir(spark, "sheets")
    scan(spark, sf, "customer").select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("name!")).repartition(3).write.option("header", True).csv(at)
    return io.load_delimited_batch(spark, f"{at}/*.csv")


@add("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def sink_ctas(spark, sf):
    at = io.work_dir(spark, "ctas")
    io.write_table(scan(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")), at, "error")
    return spark.read.parquet(at)


@add("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def sink_insert_overwrite(spark, sf):
    at = io.work_dir(spark, "replaced")
    o = scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    io.write_table(o.where("o_orderkey % 2 = 0"), at)
    io.write_table(o.where("o_orderkey % 2 = 1"), at, by=["o_orderstatus"])
    return spark.read.parquet(at)


@add("SELECT event_type AS status, count(*) AS n FROM events WHERE event_id % 5 < 2 GROUP BY 1")
def sink_append_log(spark, sf):
    at = io.work_dir(spark, "log")
    for k in range(2):
        io.write_table(scan(spark, sf, "events").where(F.col("event_id") % 5 == k), at, "append")
    return spark.read.parquet(at).groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@add("SELECT o_orderkey, o_orderstatus FROM orders")
def snapshot_copy(spark, sf):
    at = io.snapshot_copy(scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), io.work_dir(spark, "copies"), "20240601")
    return spark.read.parquet(at)


@add("SELECT count(*) AS n, count(*) AS n_keys, true AS in_range FROM orders")
def synth_rows(spark, sf):
    """As many made-up rows as there are orders."""
    rows = io.synth_rows(spark, scan(spark, sf, "orders").count(), 7)
    return rows.agg(F.count("*").alias("n"), F.countDistinct("record_key").alias("n_keys"), F.min(F.col("number_col_1").between(0, 1000)).alias("in_range"))


# --- streams: two rounds of change files, the second after the stream has ended ---
_STREAM = ("o_orderkey % 10 < 2", "o_orderkey % 10 between 2 and 4")


def _rounds(spark, sf, each):
    at = io.work_dir(spark, "changes")
    batch = _batch(spark, sf)
    for part in _STREAM:
        batch.where(part).repartition(2).write.mode("append").parquet(at)
        each(spark.readStream.schema(batch.schema).parquet(at))


def _versioned(spark, sf, order=()):
    table = VersionedTable(spark, io.work_dir(spark, "versions"), ["o_orderkey"], order)
    table.write(_target(spark, sf))
    return table


_STREAMED = f"WITH {_OLD}, s AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 < 2 THEN CAST(price + 1 AS DECIMAL(18,2)) ELSE price END AS price, o_orderdate FROM src WHERE o_orderkey % 10 < 4) " + _after(f"{_K} IN (0, 1, 3)", f"coalesce({_K} = 2 AND t.o_orderkey IS NOT NULL, false)")
_ROUND = "REPLACE (CASE WHEN cdc_operation = 'UPDATE' AND o_orderkey % 10 = 3 THEN 'INSERT' ELSE cdc_operation END AS cdc_operation, CASE WHEN source_load_batch_id = 'B0' THEN 'B0' WHEN o_orderkey % 10 < 2 THEN 'BATCH_0' ELSE 'BATCH_1' END AS source_load_batch_id)"


_LOG = "log AS (SELECT event_id % 400 AS o_orderkey, event_type AS o_orderstatus, CAST(value AS DECIMAL(18,2)) AS price, ts AS o_orderdate, event_id AS seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events)"


@add(f"WITH {_OLD}, {_LOG}, p AS (SELECT o_orderkey, max(seq) AS z, min(seq) AS a FROM log WHERE op <> 'D' GROUP BY 1), c AS (SELECT o_orderkey, max(seq) AS z FROM log WHERE op = 'D' GROUP BY 1), x AS (SELECT coalesce(t.o_orderkey, p.o_orderkey) AS o_orderkey, t.o_orderkey IS NOT NULL OR p.a < p.z AS known, CASE WHEN p.z IS NULL THEN t.o_orderstatus ELSE l.o_orderstatus END AS o_orderstatus, CASE WHEN p.z IS NULL THEN t.price ELSE l.price END AS price, CASE WHEN p.z IS NULL THEN t.o_orderdate ELSE l.o_orderdate END AS o_orderdate, l.op, t.cdc_operation, p.z FROM t FULL JOIN p ON p.o_orderkey = t.o_orderkey LEFT JOIN log l ON l.seq = p.z) SELECT x.o_orderkey, x.o_orderstatus, x.price, x.o_orderdate, coalesce(c.z > coalesce(x.z, -1), false) AS is_deleted, CASE WHEN c.z > coalesce(x.z, -1) THEN 'DELETE' WHEN x.z IS NULL THEN x.cdc_operation WHEN x.op = 'U' AND x.known THEN 'UPDATE' ELSE 'INSERT' END AS cdc_operation FROM x LEFT JOIN c ON c.o_orderkey = x.o_orderkey")
def stream_cdc_apply(spark, sf):
    """Many changes a key in and across three batches, of which the second comes late and the third repeats old ones."""
    log = scan(spark, sf, "events").selectExpr("event_id % 400 AS o_orderkey", "event_type AS o_orderstatus", "CAST(value AS DECIMAL(18,2)) AS price", "ts AS o_orderdate", "event_id AS seq", "CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS cdc_action", "event_type NOT IN ('signup', 'error') AS cdc_is_update", "CAST(event_id AS STRING) AS row_id")
    table, at, check = _versioned(spark, sf, ["seq"]), io.work_dir(spark, "changes"), io.work_dir(spark, "offsets")
    for part in ("seq % 3 <> 1", "seq % 3 = 1", "seq % 5 = 0"):
        log.where(part).repartition(3).write.mode("append").parquet(at)
        streams.stream_cdc_apply(spark.readStream.schema(log.schema).parquet(at), table, check, None, _at()).awaitTermination()
    return table.read().select("o_orderkey", "o_orderstatus", "price", "o_orderdate", "is_deleted", "cdc_operation")


@add(f"SELECT * {_ROUND} FROM ({_STREAMED})")
def stream_cdc_batches(spark, sf):
    """One change a key, with the batch that each came in; versions are the order."""
    table, check = _versioned(spark, sf), io.work_dir(spark, "offsets")
    _rounds(spark, sf, lambda s: streams.stream_cdc_apply(s, table, check, None, _at()).awaitTermination())
    return table.read()


@add("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 3")
def stream_append_only(spark, sf):
    to, check = io.work_dir(spark, "inserts"), io.work_dir(spark, "offsets")
    _rounds(spark, sf, lambda s: streams.stream_append_only(s, to, check).awaitTermination())
    return spark.read.parquet(to).select("o_orderkey")


@add("SELECT true AS first_round, true AS second_round, false AS third_round, count(*) FILTER (o_orderkey % 10 < 5) AS n_rows FROM orders")
def stream_has_data_gate(spark, sf):
    check, ran, seen = io.work_dir(spark, "offsets"), [], []
    last = []

    def each(s):
        last[:] = [s]
        ran.append(streams.stream_has_data_gate(s, check, lambda batch, n: seen.append(batch.count())))

    _rounds(spark, sf, each)
    ran.append(streams.stream_has_data_gate(last[0], check, lambda batch, n: seen.append(batch.count())))
    return spark.createDataFrame([(*ran, sum(seen))], "first_round boolean, second_round boolean, third_round boolean, n_rows long")


@add("SELECT user_id, event_type, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_incremental_current(spark, sf):
    e = scan(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    at, check = io.work_dir(spark, "changes"), io.work_dir(spark, "offsets")
    table = VersionedTable(spark, io.work_dir(spark, "versions"), ["user_id"], ["ts", "event_id"])
    table.write(history.latest(e.where("event_id % 4 = 0"), ["user_id"], [F.desc("ts"), F.desc("event_id")]))
    for part in ("event_id % 4 = 1", "event_id % 4 > 1"):
        e.where(part).write.mode("append").parquet(at)
        streams.stream_incremental_current(spark.readStream.schema(e.schema).parquet(at), table, check).awaitTermination()
    return table.read()


@add("SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 2 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price, o_orderkey % 10 = 2 AS is_deleted, CASE WHEN o_orderkey % 10 < 2 THEN 'UPDATE' WHEN o_orderkey % 10 = 2 THEN 'DELETE' WHEN o_orderkey % 10 = 3 THEN 'INSERT' WHEN o_orderkey % 7 = 0 THEN 'INSERT' ELSE 'RELOADED' END AS cdc_operation FROM orders")
def stream_offset_recovery(spark, sf):
    """The second round finds another checkpoint: the base is reloaded, then the change files are read again."""
    table, checks = _versioned(spark, sf), [io.work_dir(spark, "offsets") for _ in range(2)]
    _rounds(spark, sf, lambda s: streams.stream_offset_recovery(spark, s, _source(spark, sf), table, checks.pop(), _at())[1].awaitTermination())
    return table.read().select("o_orderkey", "price", "is_deleted", "cdc_operation")


@add("WITH x AS (SELECT user_id, event_id, ts, ts + INTERVAL 1 HOUR * CAST(event_id % 100 * 10 AS INTEGER) AS loaded FROM events) SELECT *, ts < TIMESTAMP '2024-01-25' AS is_late FROM x WHERE loaded >= TIMESTAMP '2024-01-25' AND loaded < TIMESTAMP '2024-01-28' AND ts >= TIMESTAMP '2023-12-26'")
def late_rows(spark, sf):
    e = scan(spark, sf, "events").select("user_id", "event_id", "ts").withColumn("loaded", F.col("ts") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 100 * 10).cast("int")))
    return streams.late_rows(e, "ts", "loaded", _at("2024-01-25"), _at("2024-01-28"), 30, ["event_id"])


# --- movement ---


@add("WITH l AS (SELECT event_id, user_id, date_trunc('hour', ts) AS s, date_trunc('hour', ts) + CAST(event_id % 50 AS INTEGER) * INTERVAL 1 HOUR AS e FROM events) SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM l b WHERE b.user_id = l.user_id AND b.s < l.s AND b.e > l.e)")
def anti_contained_interval(spark, sf):
    hour = F.date_trunc("hour", "ts")
    legs = scan(spark, sf, "events").select("event_id", "user_id", hour.alias("s"), (hour + F.make_dt_interval(F.lit(0), (F.col("event_id") % 50).cast("int"))).alias("e"))
    return movement.anti_contained(legs, ["user_id"], "s", "e")


@add("SELECT event_id, user_id, event_type, ts, lag(ts) OVER w AS from_ts, lag(event_type) OVER w AS from_event_type, lead(event_type) OVER w AS next_event_type FROM (SELECT event_id, nullif(user_id, 3) AS user_id, event_type, ts FROM events) WINDOW w AS (PARTITION BY coalesce(user_id, 0) ORDER BY ts, event_id) QUALIFY from_ts IS NOT NULL")
def movement_legs(spark, sf):
    e = scan(spark, sf, "events").select("event_id", F.nullif(F.col("user_id"), F.lit(3)).alias("user_id"), "event_type", "ts")
    return movement.movement_legs(e, ["user_id"], "ts", "event_id", ["event_type"], ["event_type"], {"user_id": 0})


_ZONES = "SELECT k AS nbr, 'Z' || k || '_' || part AS zone, part * 10 AS zlo, part * 10 + 15 AS zhi FROM (SELECT DISTINCT p_size % 7 AS k FROM part), range(0, 4) r(part)"


@add(f"WITH z AS ({_ZONES}), p AS (SELECT p_partkey, p_size % 9 AS nbr, p_partkey % 40 AS lo, p_partkey % 40 + p_size % 12 AS hi FROM part) SELECT p.*, z.zone, z.zlo, z.zhi FROM p LEFT JOIN z ON p.nbr = z.nbr AND ((p.lo >= z.zlo AND p.lo < z.zhi) OR (p.hi >= z.zlo AND p.hi <= z.zhi))")
def range_zone_join(spark, sf):
    part = scan(spark, sf, "part")
    zones = part.selectExpr("p_size % 7 AS nbr").distinct().selectExpr("nbr", "explode(sequence(0, 3)) AS part").selectExpr("nbr", "concat('Z', nbr, '_', part) AS zone", "CAST(part * 10 AS BIGINT) AS zlo", "CAST(part * 10 + 15 AS BIGINT) AS zhi")
    rows = part.selectExpr("p_partkey", "p_size % 9 AS nbr", "p_partkey % 40 AS lo", "p_partkey % 40 + p_size % 12 AS hi")
    return movement.range_zone_join(rows, zones, "nbr", "lo", "hi", "zlo", "zhi", 20)


_OD = "SELECT l_orderkey AS od_id, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_suppkey % 6 END AS subdivision_nbr, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS subdivision_name, l_quantity AS miles, l_linestatus = 'O' OR l_linenumber > 2 AS is_active FROM lineitem"
_BREAK = "SELECT l_orderkey AS od_id, l_suppkey % 6 AS from_nbr, l_returnflag AS from_name, l_suppkey % 6 + l_linenumber % 2 AS to_nbr, l_quantity AS low_miles, l_quantity + l_linenumber AS high_miles FROM lineitem"
_ZONE = "SELECT DISTINCT CAST(p_size % 5 AS BIGINT) AS subdivision_nbr, 'R' || p_size % 2 AS region, 'Z' || p_size % 5 AS zone, 'D' || p_size % 3 AS division, (p_size % 3 * 20)::DOUBLE AS low_mile, (p_size % 3 * 20 + 25)::DOUBLE AS high_mile FROM part"
_OD_SQL = f"WITH st AS ({_OD}), br AS ({_BREAK}), c AS ({_ZONE}), a AS (SELECT od_id, coalesce(subdivision_nbr, 0) AS nbr, coalesce(subdivision_name, 'X') AS nm, sum(miles) AS miles FROM st WHERE is_active GROUP BY od_id, subdivision_nbr, subdivision_name), b AS (SELECT od_id, from_nbr, from_name, to_nbr, min(low_miles) AS lo, max(high_miles) AS hi FROM br GROUP BY 1, 2, 3, 4) SELECT a.od_id, a.nbr AS subdivision_nbr, a.nm AS subdivision_name, c.region, c.zone, c.division, CASE WHEN count(*) OVER (PARTITION BY a.od_id, a.nbr) = 1 THEN a.miles WHEN b.lo >= c.low_mile AND b.lo <= c.high_mile THEN CASE WHEN abs(c.high_mile - b.lo) > a.miles THEN CASE WHEN abs(abs(c.high_mile - a.miles) - a.miles) > a.miles THEN a.miles ELSE abs(abs(c.high_mile - a.miles) - a.miles) END ELSE abs(c.high_mile - b.lo) END ELSE CASE WHEN abs(abs(c.low_mile - b.lo) - a.miles) > a.miles THEN 0 ELSE abs(abs(c.low_mile - b.lo) - a.miles) END END AS miles FROM a LEFT JOIN b ON a.od_id = b.od_id AND a.nbr = b.from_nbr AND a.nbr = b.to_nbr LEFT JOIN c ON a.nbr = c.subdivision_nbr AND c.subdivision_nbr = b.to_nbr AND ((b.lo >= c.low_mile AND b.lo < c.high_mile) OR (b.hi >= c.low_mile AND b.hi <= c.high_mile))"


@add(_OD_SQL)
def od_subdivision_miles(spark, sf):
    line = scan(spark, sf, "lineitem")
    st = line.selectExpr("l_orderkey AS od_id", "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_suppkey % 6 END AS subdivision_nbr", "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS subdivision_name", "l_quantity AS miles", "l_linestatus = 'O' OR l_linenumber > 2 AS is_active")
    br = line.selectExpr("l_orderkey AS od_id", "l_suppkey % 6 AS from_nbr", "l_returnflag AS from_name", "l_suppkey % 6 + l_linenumber % 2 AS to_nbr", "l_quantity AS low_miles", "l_quantity + l_linenumber AS high_miles")
    zones = scan(spark, sf, "part").selectExpr("CAST(p_size % 5 AS BIGINT) AS subdivision_nbr", "concat('R', p_size % 2) AS region", "concat('Z', p_size % 5) AS zone", "concat('D', p_size % 3) AS division", "CAST(p_size % 3 * 20 AS DOUBLE) AS low_mile", "CAST(p_size % 3 * 20 + 25 AS DOUBLE) AS high_mile").distinct()
    return movement.od_subdivision_miles(st, br, zones, 30)


_ORPHAN = """WITH e AS (SELECT event_id, user_id, nullif(event_id % 3, 2) AS station, date_trunc('minute', ts) AS seen FROM events WHERE event_type = 'error'),
c AS (SELECT user_id, event_id % 3 AS station, date_trunc('minute', ts) + n * INTERVAL 3 SECOND * (event_id % 7) AS changed, date_trunc('minute', ts) AS reported, event_id // 20 * 20 AS cnst_id, event_id % 4 AS version, event_type AS status FROM events, range(0, 2) r(n) WHERE event_type <> 'error' OR event_id % 3 <> 1),
m AS (SELECT e.*, c.cnst_id, c.version, c.changed, c.status, min(c.changed) OVER (PARTITION BY e.user_id, e.station) AS least FROM e LEFT JOIN c ON e.user_id = c.user_id AND e.station = c.station AND e.seen = c.reported),
k AS (SELECT *, max(cnst_id) OVER (PARTITION BY event_id) AS top, max(version) OVER (PARTITION BY cnst_id, event_id) AS top_version FROM m WHERE seen >= coalesce(changed, seen) OR changed = least)
SELECT event_id, user_id, station, seen, cnst_id AS matched_cnst_id, version AS matched_version, changed AS matched_changed, status AS matched_status FROM k WHERE coalesce(cnst_id, 0) = coalesce(top, 0) AND coalesce(version, 0) = coalesce(top_version, 0)"""


def _orphans(spark, sf):
    """Errors as events without a train, at a station (unknown for some); other events twice as changes, reported in the minute that
    they happened and effective then or some seconds after."""
    e = scan(spark, sf, "events").withColumn("seen", F.date_trunc("minute", "ts"))
    events = e.where("event_type = 'error'").selectExpr("event_id", "user_id", "nullif(event_id % 3, 2) AS station", "seen")
    changes = e.where("event_type <> 'error' or event_id % 3 <> 1").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    changes = changes.selectExpr("user_id", "event_id % 3 AS station", "seen + make_dt_interval(0, 0, 0, n * 3 * (event_id % 7)) AS changed", "seen AS reported", "event_id div 20 * 20 AS cnst_id", "event_id % 4 AS version", "event_type AS status")
    return events, changes


@add(_ORPHAN)
def orphan_event_match(spark, sf):
    return movement.orphan_match(*_orphans(spark, sf), {"user_id": "user_id", "station": "station"}, "event_id", "seen", "reported", ("cnst_id", "version"), ["changed", "status"])


@add("SELECT a.event_id, b.event_id AS other, b.event_type AS other_type FROM events a LEFT JOIN (SELECT *, date_trunc('day', ts) AS d FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND date_trunc('day', a.ts) = b.d WHERE a.event_type = 'error' QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.event_id DESC NULLS LAST) = 1")
def orphan_event_match_by_day(spark, sf):
    """Days as times; those without a match stay."""
    e = scan(spark, sf, "events").withColumn("d", F.date_trunc("day", "ts"))
    views = e.where("event_type = 'view'").withColumn("version", F.lit(0))
    met = movement.orphan_match(e.where("event_type = 'error'").select("event_id", "user_id", "d"), views, {"user_id": "user_id"}, "event_id", "d", "d", ("event_id", "version"), within=["user_id"])
    kinds = views.select(F.col("event_id").alias("matched_event_id"), F.col("event_type").alias("other_type"))
    return met.join(kinds, "matched_event_id", "left").select("event_id", F.col("matched_event_id").alias("other"), "other_type")


# --- sales ---
_NET = "round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) * CAST(1 + l_tax AS DECIMAL(4,2)), 2)"


@add(f"SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority, count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT o_custkey) AS unique_customers, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE / count(o_totalprice) AS average, min(o_totalprice) AS least, max(o_totalprice) AS most, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS quantity, sum({_NET})::DOUBLE AS net_amount, count(l_linenumber) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3")
def gold_daily_sales(spark, sf):
    return sales.gold_daily_sales(scan(spark, sf, "orders"), scan(spark, sf, "lineitem"))


_TODAY = "DATE '2001-08-15'"
_C360 = f"WITH c AS (SELECT c_custkey AS custkey, DATE '1930-01-01' + CAST(c_custkey * 37 % 26000 AS INTEGER) AS birth_date FROM customer), o AS (SELECT o_orderkey AS orderkey, o_custkey AS custkey, CAST(o_orderdate AS DATE) AS order_date, floor(o_totalprice / 100) AS amount, o_orderpriority AS category, o_orderstatus AS channel FROM orders), p AS (SELECT c.custkey, birth_date, count(DISTINCT orderkey) AS total_orders, coalesce(sum(amount::DECIMAL(18,2)), 0)::DOUBLE AS lifetime_value, coalesce(coalesce(sum(amount::DECIMAL(18,2)), 0)::DOUBLE / nullif(count(amount), 0), 0) AS average_order_value, min(order_date) AS first_order, max(order_date) AS last_order FROM c LEFT JOIN o ON o.custkey = c.custkey GROUP BY 1, 2), q AS (SELECT *, date_diff('day', last_order, {_TODAY})::INT AS idle FROM p), m1 AS (SELECT custkey, category FROM o GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY count(*) DESC, category) = 1), m2 AS (SELECT custkey, channel FROM o GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY count(*) DESC, channel) = 1), r AS (SELECT q.* EXCLUDE (idle), CASE WHEN lifetime_value >= 10000 THEN 'VIP' WHEN lifetime_value >= 5000 THEN 'High Value' WHEN lifetime_value >= 1000 THEN 'Medium Value' ELSE 'Low Value' END AS customer_segment, idle AS days_since_last_order, CASE WHEN total_orders > 1 THEN date_diff('day', first_order, last_order)::DOUBLE / total_orders END AS order_frequency_days, least(1.0::DOUBLE, (CASE WHEN idle <= 30 THEN 0.4::DOUBLE ELSE 0 END) + (CASE WHEN total_orders >= 5 THEN 0.3::DOUBLE ELSE total_orders * 0.06::DOUBLE END) + (CASE WHEN lifetime_value >= 1000 THEN 0.3::DOUBLE ELSE lifetime_value / 1000 * 0.3::DOUBLE END)) AS engagement_score, CASE WHEN idle > 180 THEN 0.9 WHEN idle > 90 THEN 0.6 WHEN idle > 60 THEN 0.3 ELSE 0.1 END::DOUBLE AS churn_risk_score, CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_group, idle <= 90 AS is_active, CASE WHEN total_orders = 0 THEN 'Never Purchased' WHEN idle > 180 THEN 'Inactive' WHEN idle > 90 THEN 'At Risk' ELSE 'Active' END AS customer_status, m1.category AS preferred_category, m2.channel AS preferred_channel, ntile(5) OVER (ORDER BY last_order NULLS FIRST, q.custkey)::INT AS recency_score, ntile(5) OVER (ORDER BY total_orders, q.custkey)::INT AS frequency_score, ntile(5) OVER (ORDER BY lifetime_value, q.custkey)::INT AS monetary_score FROM (SELECT *, year({_TODAY}) - year(birth_date) AS age FROM q) q LEFT JOIN m1 ON m1.custkey = q.custkey LEFT JOIN m2 ON m2.custkey = q.custkey) "
_SEGMENT = "CASE WHEN recency_score >= 4 AND frequency_score >= 4 THEN 'Champions' WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal' WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'Promising' WHEN recency_score <= 2 AND frequency_score >= 4 THEN 'At Risk' WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'Lost' ELSE 'Regular' END"


@add(_C360 + f"SELECT * EXCLUDE (age), {_SEGMENT} AS rfm_segment FROM r")
def customer_360(spark, sf):
    c = scan(spark, sf, "customer").selectExpr("c_custkey AS custkey", "DATE '1930-01-01' + CAST(c_custkey * 37 % 26000 AS INT) AS birth_date")
    o = scan(spark, sf, "orders").selectExpr("o_orderkey AS orderkey", "o_custkey AS custkey", "CAST(o_orderdate AS DATE) AS order_date", "floor(o_totalprice / 100) AS amount", "o_orderpriority AS category", "o_orderstatus AS channel")
    return sales.customer_360(c, o, F.lit("2001-08-15").cast("date"))


@add("SELECT event_id, ntile(7) OVER (ORDER BY value DESC, event_id)::INT AS tile FROM events")
def ntile_rfm(spark, sf):
    return sales.ntiles(scan(spark, sf, "events").select("event_id", "value"), [F.desc("value"), F.col("event_id")], 7, "tile").drop("value")


@add("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def row_id_rownum(spark, sf):
    return sales.row_numbers(scan(spark, sf, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], "id").select("o_orderkey", F.col("id").cast("int").alias("id"))


_KPI = "WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue, sum(floor(o_totalprice * (o_orderkey % 4) / 10)::DECIMAL(18,2))::DOUBLE AS profit, count(*) AS n_orders, count(DISTINCT o_custkey) AS active_customers FROM orders GROUP BY 1)"


def _kpis(spark, sf):
    facts = scan(spark, sf, "orders").selectExpr("o_orderdate AS sale_date", "o_totalprice AS revenue", "floor(o_totalprice * (o_orderkey % 4) / 10) AS profit", "1 AS n_orders", "o_custkey AS custkey")
    return sales.monthly_kpis(facts)


@add(f"{_KPI} SELECT month::TIMESTAMP AS month, revenue, profit, n_orders, active_customers, lag(revenue) OVER w AS previous, (revenue - lag(revenue) OVER w) / lag(revenue) OVER w * 100 AS growth_pct, lag(revenue, 12) OVER w AS year_ago, (revenue - lag(revenue, 12) OVER w) / lag(revenue, 12) OVER w * 100 AS yoy_growth_pct, revenue / nullif(active_customers, 0) AS revenue_per_customer, profit / nullif(revenue, 0) * 100 AS profit_margin_pct FROM m WINDOW w AS (ORDER BY month)")
def monthly_kpis(spark, sf):
    return _kpis(spark, sf)


@add(f"{_KPI} SELECT month::TIMESTAMP AS month, lag(revenue, 12) OVER (ORDER BY month) AS year_ago FROM m")
def lag_12(spark, sf):
    return _kpis(spark, sf).select("month", "year_ago")


# --- quality and reconciliation ---


@add("SELECT count(value) - count(DISTINCT value) AS duplicate_count FROM events")
def dq_duplicate_count(spark, sf):
    return quality.column_metrics(scan(spark, sf, "events"), "value").select("duplicate_count")


@add("SELECT count(*) FILTER (c_acctbal < 0) AS negative_count FROM customer")
def dq_negative_count(spark, sf):
    return quality.column_metrics(scan(spark, sf, "customer"), "c_acctbal").select("negative_count")


@add("SELECT 'o_totalprice' AS name, 'double' AS source_type, 'decimal(18,2)' AS target_type UNION ALL SELECT 'o_custkey', 'bigint', NULL UNION ALL SELECT 'extra', NULL, 'int'")
def recon_schema(spark, sf):
    o = scan(spark, sf, "orders")
    other = o.drop("o_custkey").withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "extra": F.lit(1)})
    return quality.recon_schema(o, other)


@add("SELECT 'price' AS rule, count(*) FILTER (o_totalprice <= 1000) AS violations, count(*) FILTER (o_totalprice <= 1000) = 0 AS passed FROM orders UNION ALL SELECT 'key', 0, true UNION ALL SELECT 'lines', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)), (SELECT count(*) = 0 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))")
def recon_rules(spark, sf):
    rules = {"price": "SELECT * FROM {orders} WHERE o_totalprice <= 1000", "key": "SELECT * FROM {orders} WHERE o_orderkey IS NULL", "lines": "SELECT * FROM {orders} LEFT ANTI JOIN {lineitem} ON l_orderkey = o_orderkey"}
    return quality.recon_rules(rules, orders=scan(spark, sf, "orders"), lineitem=scan(spark, sf, "lineitem"))


@add("SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) FILTER (o_orderkey % 3 = 0) AS stream_rows, count(*) FILTER (o_orderkey % 7 <> 0) AS target_rows FROM orders UNION ALL SELECT 'customer', count(*), 0, count(*) FROM customer")
def recon_counts_union(spark, sf):
    o, c = scan(spark, sf, "orders"), scan(spark, sf, "customer")
    return quality.recon_counts_union({"orders": (o, o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 7 <> 0")), "customer": (c, c.limit(0), c)})


_ROW = "concat_ws('|', o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, o_orderpriority)"


@add(f"SELECT count(*) AS n_rows, sum(('0x' || substr(md5({_ROW}), 1, 14))::BIGINT)::VARCHAR AS table_hash FROM orders")
def recon_hash_text(spark, sf):
    return quality.recon_hash_text(scan(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@add("SELECT o_orderkey, '<row>' AS column_name, 'present' AS source_value, NULL AS target_value FROM orders WHERE o_orderkey % 20 = 1 UNION ALL SELECT o_orderkey, '<row>', NULL, 'present' FROM orders WHERE o_orderkey % 20 = 2 UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, 'X' FROM orders WHERE o_orderkey % 30 = 0")
def full_outer_row_diff(spark, sf):
    o = scan(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    other = o.where("o_orderkey % 20 <> 1").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 30 == 0, "X").otherwise(F.col("o_orderpriority"))).withColumn("o_orderdate", _at())
    return quality.row_diff(o.where("o_orderkey % 20 <> 2"), other, ["o_orderkey"], exclude=["o_orderdate"])


@add("SELECT p_partkey, md5(concat_ws('|', coalesce(p_name, ''), coalesce(CAST(p_size AS VARCHAR), ''), coalesce(p_brand, ''))) AS h FROM part")
def md5_fields(spark, sf):
    return scan(spark, sf, "part").select("p_partkey", cdc.row_hash(["p_name", "p_size", "p_brand"], "|").alias("h"))


@add("SELECT event_id, min(ts) OVER (PARTITION BY user_id, event_type) AS first_ts FROM events")
def min_over_partition(spark, sf):
    from pyspark.sql import Window

    return scan(spark, sf, "events").select("event_id", F.min("ts").over(Window.partitionBy("user_id", "event_type")).alias("first_ts"))


@add("SELECT e.event_id, k.kinds FROM events e JOIN (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1) k ON k.user_id = e.user_id")
def listagg_over_partition(spark, sf):
    """The list of each partition's values beside its rows: made once for each key, and joined."""
    e = scan(spark, sf, "events")
    kinds = e.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))
    return e.join(kinds, "user_id").select("event_id", "kinds")


@add("SELECT 'orders' AS t, count(*) AS n, count(DISTINCT o_orderkey) AS keys, count(*) FILTER (o_orderkey IS NULL) AS null_keys, count(*) FILTER (o_totalprice < 0) AS negatives, date_diff('minute', max(o_orderdate), TIMESTAMP '2001-09-01') AS minutes_since_refresh FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), count(*) FILTER (l_orderkey IS NULL), count(*) FILTER (l_extendedprice < 0), date_diff('minute', max(l_shipdate), TIMESTAMP '2001-09-01') FROM lineitem")
def dq_pipeline_health(spark, sf):
    now = _at("2001-09-01")
    return quality.pipeline_health({"orders": (scan(spark, sf, "orders"), "o_orderkey", "o_totalprice", "o_orderdate"), "lineitem": (scan(spark, sf, "lineitem"), "l_orderkey", "l_extendedprice", "l_shipdate")}, now)


@add("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY l_orderkey")
def dq_relationships(spark, sf):
    known = scan(spark, sf, "part").where("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return scan(spark, sf, "lineitem").where("l_partkey is not null").join(known, "l_partkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@add("SELECT c_custkey, upper(trim(c_name)) AS c_name, trim(c_mktsegment) AS c_mktsegment, c_nationkey, TIMESTAMP '2024-06-01' AS load_ts, 'ERP' AS source_system FROM (SELECT c_custkey, '  ' || upper(c_name) || ' ' AS c_name, c_mktsegment, c_nationkey FROM customer)")
def silver_standardize(spark, sf):
    c = scan(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("c_name"), "c_mktsegment", "c_nationkey")
    return quality.standardize(c, _at(), "ERP")


_CHECKS = "SELECT 'DUPLICATE_KEY' AS issue, count(*) AS n_issues FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'MISSING_SEGMENT', count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer UNION ALL SELECT 'NEGATIVE_PRICE', count(*) FILTER (o_totalprice < 0) FROM orders"


@add(f"SELECT issue, n_issues, CASE WHEN n_issues > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, d AS checked_at FROM ({_CHECKS}), (SELECT unnest([TIMESTAMP '2024-06-01', TIMESTAMP '2024-06-02']) AS d)")
def dq_validate_log(spark, sf):
    """Two runs of the checks, appended to one log."""
    checks = {"DUPLICATE_KEY": scan(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").count().where("count > 1"), "MISSING_SEGMENT": scan(spark, sf, "customer").where("nullif(c_mktsegment, 'BUILDING') is null"), "NEGATIVE_PRICE": scan(spark, sf, "orders").where("o_totalprice < 0")}
    at = io.work_dir(spark, "validation")
    for day in ("2024-06-01", "2024-06-02"):
        io.write_table(quality.validate_log(checks, _at(day)), at, "append")
    return spark.read.parquet(at)


@add("SELECT o_orderkey, coalesce(c.c_custkey, -1) AS o_custkey, CASE WHEN o_orderkey % 8 = 0 THEN TIMESTAMP '1900-01-01' ELSE o_orderdate END AS o_orderdate FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey")
def dq_referential(spark, sf):
    o = scan(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return quality.referential(o, scan(spark, sf, "customer").where("c_acctbal > 0"), "o_custkey", "c_custkey", ["o_orderdate"])


@add("SELECT metric, pct, threshold, pct >= threshold AS passed FROM (SELECT 'completeness' AS metric, round(100.0 * count(*) FILTER (c_mktsegment <> 'BUILDING') / count(*), 2)::DOUBLE AS pct, 98.0::DOUBLE AS threshold FROM customer UNION ALL SELECT 'uniqueness', round(100.0 * count(DISTINCT c_custkey) / count(*), 2)::DOUBLE, 100.0 FROM customer UNION ALL SELECT 'validity', round(100.0 * count(*) FILTER (c_acctbal >= 0) / count(*), 2)::DOUBLE, 95.0 FROM customer UNION ALL SELECT 'consistency', round(100.0 * count(*) FILTER (c_nationkey BETWEEN 0 AND 24) / count(*), 2)::DOUBLE, 99.0 FROM customer)")
def dq_record_metrics(spark, sf):
    share = lambda c: F.count_if(c) / F.count("*")
    measures = {"completeness": (share(F.col("c_mktsegment") != "BUILDING"), 98), "uniqueness": (F.countDistinct("c_custkey") / F.count("*"), 100), "validity": (share(F.col("c_acctbal") >= 0), 95), "consistency": (share(F.col("c_nationkey").between(0, 24)), 99)}
    return quality.record_metrics(scan(spark, sf, "customer"), measures)


@add("SELECT source_rows, target_rows, pct, lag_minutes, CASE WHEN pct >= 99 THEN 'HEALTHY' WHEN pct >= 95 THEN 'WARNING' ELSE 'CRITICAL' END AS status FROM (SELECT count(*) AS source_rows, count(*) FILTER (event_id % 30 <> 0 AND ts < TIMESTAMP '2024-01-30 12:00:00') AS target_rows, round(100.0 * count(*) FILTER (event_id % 30 <> 0 AND ts < TIMESTAMP '2024-01-30 12:00:00') / count(*), 2)::DOUBLE AS pct, date_diff('minute', max(ts) FILTER (event_id % 30 <> 0 AND ts < TIMESTAMP '2024-01-30 12:00:00'), max(ts)) AS lag_minutes FROM events)")
def dq_source_target_match(spark, sf):
    e = scan(spark, sf, "events")
    return quality.source_target_match(e, e.where("event_id % 30 <> 0 and ts < TIMESTAMP_NTZ '2024-01-30 12:00:00'"), "ts", "ts")


# --- tables in a folder a day ---
_DAYS = "x AS (SELECT event_id, event_type, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS ts FROM events)"
_LIMIT = datetime.datetime(2024, 1, 15, 6)


def _dated(spark, sf, where="true"):
    """Events by day, some without a time."""
    table = DatedTable(spark, io.work_dir(spark, "days"), "ts")
    table.replace(scan(spark, sf, "events").where(where).select("event_id", "event_type", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("ts")))
    return table


@add("SELECT event_id, ts >= TIMESTAMP '2024-01-20' - INTERVAL 1 DAY AS is_mutable FROM events")
def immutable_split(spark, sf):
    """Days that are closed, and those that a refresh reads, each from their own folders."""
    table = DatedTable(spark, io.work_dir(spark, "days"), "ts")
    table.replace(scan(spark, sf, "events").select("event_id", "ts"))
    parts = table.open_split(datetime.date(2024, 1, 19))
    return parts[0].select("event_id", F.lit(True).alias("is_mutable")).unionByName(parts[1].select("event_id", F.lit(False).alias("is_mutable")))


@add(f"WITH {_DAYS} SELECT event_id, event_type, ts FROM x WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'")
def scan_days(spark, sf):
    return _dated(spark, sf).read(first=datetime.date(2024, 1, 10), last=datetime.date(2024, 1, 12))


@add(f"WITH {_DAYS} SELECT event_id, event_type, ts FROM x WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-15 06:00:00'")
def retention_cleanup(spark, sf):
    """Twice: what is gone already is not deleted again."""
    table = _dated(spark, sf)
    for _ in range(2):
        table.delete_before(_LIMIT)
    return table.read()


_GONE = "SELECT '{0}' AS table_name, count(*) AS rows_before, count(*) FILTER (ts < TIMESTAMP '2024-01-15 06:00:00') AS rows_deleted, count(*) FILTER (ts IS NULL OR ts >= TIMESTAMP '2024-01-15 06:00:00') AS rows_after, 'SUCCESS' AS status FROM x WHERE event_type = '{1}'"
_GONE_SQL = f"WITH {_DAYS} {_GONE.format('views_log', 'view')} UNION ALL {_GONE.format('clicks_log', 'click')} UNION ALL SELECT 'customer_log', count(*), 0, count(*), 'SKIPPED' FROM customer"


def _kept_tables(spark, sf):
    return {"views_log": _dated(spark, sf, "event_type = 'view'"), "clicks_log": _dated(spark, sf, "event_type = 'click'"), "customer_log": scan(spark, sf, "customer"), "errors": _dated(spark, sf, "event_type = 'error'")}


@add(_GONE_SQL)
def retention_schema_cleanup(spark, sf):
    """The log of a run that deletes; what the tables then hold is what the log says."""
    tables = _kept_tables(spark, sf)
    log = retention_run(spark, tables, 10, _LIMIT + datetime.timedelta(days=10), "*_log")
    left = {n: t.read().count() for n, t in tables.items() if isinstance(t, DatedTable)}
    real = F.coalesce(*[F.when(F.col("table_name") == n, F.lit(k)) for n, k in left.items()], F.col("rows_after")).cast("long")
    return log.select("table_name", "rows_before", "rows_deleted", real.alias("rows_after"), "status")


@add(f"SELECT 'logs' AS config, * FROM ({_GONE_SQL.replace('SELECT', 'SELECT', 1)}) WHERE table_name <> 'customer_log' UNION ALL SELECT 'errors' AS config, * FROM (WITH {_DAYS} {_GONE.format('errors', 'error')})")
def retention_config_cleanup(spark, sf):
    configs = [{"name": "logs", "pattern": "*_log", "excluded": ["customer_log"], "days": 10}, {"name": "off", "days": 1, "active": False}, {"name": "errors", "pattern": "err*", "days": 10}, {"name": "none", "pattern": "nothing*", "days": 1}]
    return retention_configs(spark, _kept_tables(spark, sf), configs, _LIMIT + datetime.timedelta(days=10)).drop("message", "days_dropped", "days_rewritten")


@add("SELECT DISTINCT '202401' || lpad((r_regionkey * 7 + 1)::VARCHAR, 2, '0') AS copy, r_regionkey < 2 AS removed FROM region")
def backup_copies(spark, sf):
    """A copy a week of the regions known so far; those of the first two weeks are too old."""
    at, regions = io.work_dir(spark, "copies"), scan(spark, sf, "region")
    dates = [f"202401{k * 7 + 1:02}" for k in sorted(r[0] for r in regions.select("r_regionkey").distinct().collect())]
    for d in dates:
        io.snapshot_copy(regions, at, d)
    gone = drop_old_copies(spark, at, 14, datetime.date(2024, 1, 29))
    left = [r[0] for r in spark.read.parquet(at).select(F.col("snapshot").cast("string")).distinct().collect()]
    return spark.createDataFrame([(d, d in gone and d not in left) for d in dates], "copy string, removed boolean")


# --- loads ---


@add("SELECT event_id, ts, event_type FROM events")
def watermark_load(spark, sf):
    """Four loads as the source grows, of which one breaks off after its rows are written and is done again."""
    e = scan(spark, sf, "events").select("event_id", "ts", "event_type")
    table = LoadedTable(spark, io.work_dir(spark, "loaded"))
    for day in ("2024-01-08", "2024-01-16", "2024-01-16", "2099-01-01"):
        source = e.where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
        if day == "2024-01-16":
            table.newer(source, "events", "ts").write.parquet(f"{table.path}/data/broken-{uuid.uuid4().hex}")
        table.load(source, "events", "ts")
    return table.read()


@add("SELECT c_custkey::VARCHAR AS cust_key, CASE WHEN c_custkey % 3 < 2 THEN c_name END AS name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 2 THEN c_nationkey::VARCHAR END AS nation FROM customer")
def load_delimited_layouts(spark, sf):
    """Files whose columns stand in other orders, lack or have more."""
    at, c = io.work_dir(spark, "sheets"), scan(spark, sf, "customer")
    key, name, segment, nation = F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"), F.col("c_nationkey").alias("Nation")
    for k, columns in enumerate(([key, name], [segment, name, key], [nation, key, segment])):
        c.where(F.col("c_custkey") % 3 == k).select(*columns).repartition(2).write.mode("append").option("header", True).csv(at)
    return io.load_delimited_batch(spark, f"{at}/*.csv").select("cust_key", "name", "segment", "nation")


@add("SELECT o_orderkey, CASE WHEN o_orderkey % 500 = 7 THEN '<row>' ELSE 'o_orderstatus' END AS column_name, CASE WHEN o_orderkey % 500 = 7 THEN 'present' ELSE o_orderstatus END AS source_value, CASE WHEN o_orderkey % 500 = 8 THEN o_orderstatus || '!' END AS target_value FROM orders WHERE o_orderkey % 500 IN (7, 8) OR o_orderkey % 500 = 9 AND o_orderstatus IS NOT NULL")
def recon_tree_diff(spark, sf):
    """A target without some rows, with other statuses, and with nulls."""
    o = scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey") % 500
    other = o.where(k != 7).withColumn("o_orderstatus", F.when(k == 8, F.concat("o_orderstatus", F.lit("!"))).when(k != 9, F.col("o_orderstatus")))
    return quality.tree_diff(o, other, ["o_orderkey"])


# --- text ---


@add("SELECT event_id, regexp_full_match(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS is_email FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type || '@x.org' WHEN 1 THEN 'to ' || event_type || '@x.org' WHEN 2 THEN event_type || '@x' WHEN 3 THEN event_type || '.' || user_id || '@a-b.co.uk' END AS x FROM events)")
def email_validate_whole(spark, sf):
    x = F.expr("CASE event_id % 5 WHEN 0 THEN event_type || '@x.org' WHEN 1 THEN 'to ' || event_type || '@x.org' WHEN 2 THEN event_type || '@x' WHEN 3 THEN event_type || '.' || user_id || '@a-b.co.uk' END")
    return scan(spark, sf, "events").select("event_id", text.email_valid(x).alias("is_email"))


@add("SELECT c_custkey, array_to_string(list_transform(string_split(lower(c_mktsegment || ' of  ' || c_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title, split_part(c_name, '#', -1) AS last_part, split_part(c_name, '#', 1) AS first_part, split_part(c_name, '#', 5) AS beyond, nullif(trim(regexp_replace(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE '  a   ' || c_name END, '\\s+', ' ', 'g')), '') AS cleaned FROM customer")
def string_parts(spark, sf):
    name = F.col("c_name")
    messy = F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.concat(F.lit("  a   "), name))
    return scan(spark, sf, "customer").select("c_custkey", F.initcap(F.concat("c_mktsegment", F.lit(" of  "), name)).alias("title"), text.part(name, "#", -1).alias("last_part"), text.part(name, "#", 1).alias("first_part"), text.part(name, "#", 5).alias("beyond"), text.clean(messy).alias("cleaned"))


@add("SELECT o_orderkey, coalesce(try_strptime(x, '%d.%m.%Y'), try_strptime(x, '%Y/%m/%d %H:%M:%S')) AS t, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) WHEN 1 THEN -CAST(o_totalprice AS DECIMAL(18,2)) WHEN 2 THEN CAST(o_custkey * 1000 + 1234567.5 AS DECIMAL(18,2)) END AS n FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') ELSE o_orderstatus END AS x FROM orders)")
def safe_convert_formats(spark, sf):
    """Times in two formats, amounts with commas, signs and brackets, and what is neither."""
    o = scan(spark, sf, "orders")
    x = F.expr("CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'dd.MM.yyyy') WHEN 1 THEN date_format(o_orderdate, 'yyyy/MM/dd HH:mm:ss') ELSE o_orderstatus END")
    price = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
    amount = F.expr(f"CASE o_orderkey % 4 WHEN 0 THEN ' $' || {price} WHEN 1 THEN '(' || {price} || ')' WHEN 2 THEN format_number(o_custkey * 1000 + 1234567.5, 2) ELSE o_orderpriority END")
    return o.select("o_orderkey", text.to_time(x, ["dd.MM.yyyy", "yyyy/MM/dd HH:mm:ss"]).alias("t"), text.to_number(amount).alias("n"))
