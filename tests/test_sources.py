import datetime
import os

import pytest
from pyspark.sql import functions as F

from driftlake.operators import monitoring, quality
from driftlake.sources import tables as io
from driftlake.sources.dated import DatedTable, drop_old_copies, retention_configs, retention_run
from driftlake.sources.manifests import LoadedTable

T = datetime.datetime(2024, 1, 1)


def _files(path) -> dict[str, float]:
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _dated(spark, path, n=40):
    table = DatedTable(spark, str(path), "ts")
    rows = [(i, None if i % 10 == 0 else T + datetime.timedelta(hours=6 * i)) for i in range(n)]
    table.replace(spark.createDataFrame(rows, "id int, ts timestamp_ntz"))
    return table, rows


def test_deletion_leaves_the_files_of_kept_days(spark, tmp_path):
    table, rows = _dated(spark, tmp_path / "t")
    limit = datetime.datetime(2024, 1, 4, 9)
    before = _files(tmp_path / "t")
    log = table.delete_before(limit)
    kept = [i for i, ts in rows if ts is None or ts >= limit]
    assert sorted(r["id"] for r in table.read().collect()) == kept
    assert log == {"rows_before": 40, "rows_deleted": 40 - len(kept), "rows_after": len(kept), "days_dropped": 3, "days_rewritten": 1}
    after = _files(tmp_path / "t")
    untouched = {f for f in before if "on_day=" in f and ("__HIVE" in f or f.split("on_day=")[1][:10] > "2024-01-04")}
    assert untouched and all(after[f] == before[f] for f in untouched)
    assert not any("on_day=2024-01-0" + d in f for f in after for d in "123")
    assert table.delete_before(limit) == {"rows_before": len(kept), "rows_deleted": 0, "rows_after": len(kept), "days_dropped": 0, "days_rewritten": 0}
    # a run that broke off after some folders
    table.drop([datetime.date(2024, 1, 5)])
    assert table.delete_before(datetime.datetime(2024, 1, 7))["rows_after"] == table.read().count()


def test_reads_open_only_the_days_asked_for(spark, tmp_path):
    table, rows = _dated(spark, tmp_path / "t")
    some = table.read(first=datetime.date(2024, 1, 3), last=datetime.date(2024, 1, 4))
    assert sorted(r["id"] for r in some.collect()) == [i for i, ts in rows if ts and ts.day in (3, 4)]
    assert "PartitionFilters: [isnotnull(on_day" in some._jdf.queryExecution().toString()
    assert len(some.inputFiles()) > 4  # of the table; the plan prunes them
    read = some.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("on_day=")[1][:10] for r in read} == {"2024-01-03", "2024-01-04"}
    open_, closed = table.open_split(datetime.date(2024, 1, 8))
    assert sorted(r["id"] for r in open_.collect()) == [i for i, ts in rows if ts is None or ts.day >= 8]
    assert {r["f"].split("on_day=")[1][:10] for r in closed.select(F.input_file_name().alias("f")).distinct().collect()} == {f"2024-01-0{d}" for d in range(1, 8)}


def test_writing_some_days_leaves_the_others(spark, tmp_path):
    table, rows = _dated(spark, tmp_path / "t")
    before = _files(tmp_path / "t")
    table.replace(spark.createDataFrame([(99, datetime.datetime(2024, 1, 2, 1))], "id int, ts timestamp_ntz"))
    assert sorted(r["id"] for r in table.read().collect()) == sorted([99, *[i for i, ts in rows if ts is None or ts.day != 2]])
    assert sum(f in before for f in _files(tmp_path / "t")) == sum("on_day=2024-01-02" not in f for f in before)


def test_retention_runs_without_tables_and_with_failures(spark, tmp_path):
    assert retention_run(spark, {}, 5, T).collect() == [] and retention_configs(spark, {}, [{"name": "a", "days": 1}], T).collect() == []
    broken = DatedTable(spark, str(tmp_path / "b"), "gone")
    broken.add(spark.createDataFrame([(T,)], "gone timestamp_ntz"))
    broken.ts_col = "other"
    table, _ = _dated(spark, tmp_path / "t")
    log = retention_run(spark, {"a_broken": broken, "b_good": table, "c_empty": DatedTable(spark, str(tmp_path / "none"), "ts")}, 1, datetime.datetime(2024, 1, 5))
    assert [(r["table_name"], r["status"]) for r in log.collect()] == [("a_broken", "FAILED"), ("b_good", "SUCCESS"), ("c_empty", "SUCCESS")]
    now = F.lit(T).cast("timestamp_ntz")
    assert monitoring.retention_schema_run({}, "*", (), {}, 3, now).collect() == [] and monitoring.retention_by_config({}, [], now).collect() == []
    assert quality.validate_log({}, now).collect() == [] and quality.recon_rules({}).collect() == [] and monitoring.table_profile({}).collect() == []


def test_old_copies_go_by_their_path_and_the_newest_stays(spark, tmp_path):
    at = str(tmp_path)
    for d in ("20240101", "20240110", "20240120"):
        io.snapshot_copy(spark.range(3), at, d)
    (tmp_path / "snapshot=other").mkdir()
    assert drop_old_copies(spark, at, 15, datetime.date(2024, 1, 31)) == ["20240101", "20240110"]
    assert drop_old_copies(spark, at, 1, datetime.date(2025, 1, 31)) == [] and sorted(p.name for p in tmp_path.iterdir()) == ["snapshot=20240120", "snapshot=other"]
    assert drop_old_copies(spark, at + "/none", 1, datetime.date(2024, 1, 1)) == []


def test_a_load_that_breaks_off_loads_nothing_twice(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "source")
    spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS ts").write.parquet(source)
    rows, table = spark.read.parquet(source), LoadedTable(spark, str(tmp_path / "t"))
    assert table.load(rows.where("id < 50"), "s", "ts") == 50 and table.watermark("s") == "2024-01-03 01:00:00"
    plan = table.newer(rows, "s", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-03T01:00)]" in plan
    with monkeypatch.context() as m:
        m.setattr(LoadedTable, "_commit", lambda self, body: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            table.load(rows, "s", "ts")
    assert table.read().count() == 50 and table.watermark("s") == "2024-01-03 01:00:00"
    assert [table.load(rows, "s", "ts"), table.load(rows, "s", "ts"), table.load(rows.where("id < 5"), "other", "ts")] == [50, 0, 5]
    assert table.read().count() == 105 and table.read(0).count() == 50
    table.vacuum(1)
    assert table.read().count() == 105 and len(os.listdir(tmp_path / "t" / "data")) == 3


def test_files_of_other_headers_load_under_their_own_names(spark, tmp_path):
    for name, text in {"a": "id,name\n1,ann\n", "b": "name,id\nbob,2\n", "c": "﻿id,Extra,\"na,me\"\n3,x,y\n", "d": "", "e": "id,name\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    rows = io.load_delimited_batch(spark, f"{tmp_path}/*.csv")
    assert rows.columns == ["id", "name", "extra", "na_me"]
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "ann", None, None), ("2", "bob", None, None), ("3", None, "x", "y")]
    log = io.load_delimited(spark, {"t": f"{tmp_path}/*.csv", "none": f"{tmp_path}/*.tsv", "empty": f"{tmp_path}/d.csv"}, str(tmp_path / "to")).collect()
    assert log[0]["message"] == "name missing in 1 file, extra missing in 3 files, na_me missing in 3 files" and log[0]["n_rows"] == 3
    assert [r["status"] for r in log[:2]] == ["SUCCESS", "FAILED"]


def test_tree_diff_is_row_diff(spark, monkeypatch):
    a = spark.range(3000).selectExpr("id AS k", "CASE WHEN id % 7 > 0 THEN id % 5 END AS x", "concat('v', id) AS y")
    b = a.where("k <> 77").withColumn("x", F.when(F.col("k") == 1234, None).when(F.col("k") == 7, 3).otherwise(F.col("x"))).withColumn("y", F.when(F.col("k") == 5, "z").otherwise(F.col("y"))).unionByName(spark.createDataFrame([(9999, 1, "n")], "k long, x long, y string"))
    want = sorted(map(tuple, quality.row_diff(a, b, ["k"]).collect()))
    assert len(want) == 5 and sorted(map(tuple, quality.tree_diff(a, b, ["k"]).collect())) == want
    assert quality.tree_diff(a, a.select("y", "x", "k"), ["k"]).collect() == []
    monkeypatch.setattr(quality, "NAMED", 2)
    assert sorted(map(tuple, quality.tree_diff(a, b, ["k"]).collect())) == want


def test_days_are_written_once(spark, tmp_path, monkeypatch):
    """A refresh from the table's own rows writes them once, drops a day without rows and leaves nothing beside the days."""
    from pyspark.sql.readwriter import DataFrameWriter

    table, rows = _dated(spark, tmp_path / "t")
    before, writes, plain = _files(tmp_path / "t"), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *how: writes.append(path) or plain(self, path, *how))
    days = [datetime.date(2024, 1, d) for d in (1, 2, 3)]
    table.refresh(table.read().where("id % 2 = 0 and id not between 8 and 11"), days)
    assert len(writes) == 1 and days[2] not in table.days()
    assert sorted(r["id"] for r in table.read().collect()) == sorted([2, 4, 6, *[i for i, ts in rows if ts is None or ts.day > 3]])
    kept = {f for f in before if not any(f"on_day={d}" in f for d in days)}
    assert kept and all(_files(tmp_path / "t").get(f) == before[f] for f in kept) and not [p for p in os.listdir(tmp_path / "t") if p.startswith("_aside")]
    table.refresh(table.read(), [])
    assert kept <= set(_files(tmp_path / "t")) and not [p for p in os.listdir(tmp_path / "t") if p.startswith("_aside")]
