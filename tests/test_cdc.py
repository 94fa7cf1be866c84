import pytest
from pyspark.sql import functions as F

from driftlake.operators import cdc, history
from driftlake.sources.versioned import VersionedTable
from driftlake.streaming.apply import stream_cdc_apply


def at(x):
    return F.lit(x).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def target(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    return cdc.new_target(base, at("2024-01-01"), "B0")


def batch(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, cdc_action string, cdc_is_update boolean, row_id string")


def merged(spark, target, rows, **how):
    out = cdc.cdc_merge(target, batch(spark, rows), ["k"], at("2024-02-01"), "B1", **how)
    return {r["k"]: (r["v"], r["cdc_operation"], r["is_deleted"], str(r["record_created_at"])[:10]) for r in out.collect()}


def test_decision_table(spark, target):
    rows = [(1, "A", "INSERT", True, "r1"), (1, "a", "DELETE", True, "r0"), (2, None, "DELETE", False, "r2"), (3, "C", "INSERT", False, "r3"), (4, "d", "INSERT", False, "r4"), (9, "x", "DELETE", False, "r9"), (None, "n", "INSERT", False, "rn")]
    got = merged(spark, target, rows, insert_label="DUPLICATE_RESOLVED")
    assert got == {1: ("A", "UPDATE", False, "2024-01-01"), 2: ("b", "DELETE", True, "2024-01-01"), 3: ("C", "DUPLICATE_RESOLVED", False, "2024-01-01"), 4: ("d", "INSERT", False, "2024-02-01")}


def test_truncate_and_reload_prefers_insert(spark, target):
    assert merged(spark, target, [(1, "z", "DELETE", False, "r9"), (1, "new", "INSERT", False, "r1")])[1][:3] == ("new", "INSERT", False)


def test_empty_batch_changes_nothing(spark, target):
    assert {k: v[:2] for k, v in merged(spark, target, []).items()} == {1: ("a", "INSERT"), 2: ("b", "INSERT"), 3: ("c", "INSERT")}


def test_merge_is_idempotent(spark, target):
    b = batch(spark, [(1, "A", "INSERT", True, "r1"), (2, None, "DELETE", False, "r2")])
    once = cdc.cdc_merge(target, b, ["k"], at("2024-02-01"), "B1")
    assert sorted(cdc.cdc_merge(once, b, ["k"], at("2024-02-01"), "B1").collect()) == sorted(once.collect())


@pytest.mark.parametrize(("ops", "want"), [("I", ("INSERT", False)), ("IU", ("INSERT", False)), ("IUU", ("INSERT", False)), ("U", ("INSERT", True)), ("D", ("DELETE", False)), ("ID", None), ("DI", ("INSERT", True))])
def test_coalesce(spark, ops, want):
    log = spark.createDataFrame([(1, i, op, f"v{i}") for i, op in enumerate(ops)], "k long, seq long, op string, v string")
    rows = cdc.cdc_coalesce(log, ["k"], ["seq"], "op").collect()
    assert [(r["cdc_action"], r["cdc_is_update"], r["v"]) for r in rows] == ([(*want, f"v{len(ops) - 1}")] if want else [])


def test_history_neither_overlaps_nor_leaves_gaps(spark):
    v = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-02 00:00:00", "b"), (2, "2024-01-01 00:00:00", "c")], "k long, e string, v string").withColumn("e", F.col("e").cast("timestamp_ntz"))
    h = history.scd2_history(v, "k", ["v"], "e")
    assert [(r["v"], str(r["effective_to"]), r["is_current"]) for r in h.orderBy("k", "version").collect()] == [("a", "2024-01-01 23:59:59", False), ("b", "9999-12-31 23:59:59", True), ("c", "9999-12-31 23:59:59", True)]
    assert sorted(r["v"] for r in history.scd2_as_of(h, "2024-01-01 12:00:00").collect()) == ["a", "c"]


def test_stage_validation(spark):
    with pytest.raises(Exception, match="null in a key"):
        cdc.stage_validation(batch(spark, [(None, "a", "INSERT", False, "r")]), ["k"]).collect()


def test_stream_equals_batch(spark, target, tmp_path):
    b = batch(spark, [(1, "A", "INSERT", True, "r1"), (4, "d", "INSERT", False, "r4")])
    b.write.parquet(str(tmp_path / "in"))
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    table.write(target)
    stream_cdc_apply(spark.readStream.schema(b.schema).parquet(str(tmp_path / "in")), table, str(tmp_path / "c")).awaitTermination()
    want = cdc.cdc_merge(target, b, ["k"], at("2024-02-01"), "B1")
    assert sorted(table.read().select("k", "v", "cdc_operation").collect()) == sorted(want.select("k", "v", "cdc_operation").collect())


def test_many_changes_meet_the_base_once(spark, target, tmp_path, monkeypatch):
    """As few changes do, with new, deleted and null keys: in one full join, where a join for the base and two for new keys were."""
    from driftlake.sources import versioned

    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    table.write(target.unionByName(cdc.new_target(spark.createDataFrame([(None, "n")], "k long, v string"), at("2024-01-01"), "B0")))
    table.append(batch(spark, [(1, "A", "INSERT", True, "r1"), (2, None, "DELETE", False, "r2"), (9, None, "DELETE", False, "r9"), (4, "d", "INSERT", False, "r4")]), at("2024-02-01"), "B1")
    table.append(batch(spark, [(1, "AA", "INSERT", True, "r5"), (4, None, "DELETE", False, "r6"), (5, "e", "INSERT", False, "r7")]), at("2024-02-02"), "B2")
    few = sorted(map(repr, table.read().collect()))
    assert len(few) == 6
    monkeypatch.setattr(versioned, "FEW", 0)
    many = table.read()
    assert sorted(map(repr, many.collect())) == few
    assert many._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_a_reload_stores_no_row_ids(spark, target, tmp_path):
    """They would be the same for a key's rows; the reloaded rows stand last all the same."""
    from driftlake.streaming.apply import stream_offset_recovery

    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    table.write(target, {"cdc": 3})
    b = batch(spark, [(2, None, "DELETE", False, "r2")])
    b.write.parquet(str(tmp_path / "in"))
    base = spark.createDataFrame([(1, "A"), (2, "B"), (4, "d")], "k long, v string")
    status, stream = stream_offset_recovery(spark, spark.readStream.schema(b.schema).parquet(str(tmp_path / "in")), base, table, str(tmp_path / "none"), at("2024-02-01"))
    stream.awaitTermination()
    assert status == "RECOVERY" and sorted((r["k"], r["v"], r["cdc_operation"]) for r in table.read().collect()) == [(1, "A", "RELOADED"), (2, "B", "DELETE"), (3, "c", "INSERT"), (4, "d", "INSERT")]
    reloaded = spark.read.parquet(f"{table.path}/data/{table.manifest()['deltas'][0]['at']}")
    assert reloaded.count() == 3 and {r[0] for r in reloaded.select("_put.o.tie").collect()} == {""}
