import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from driftlake.operators import cdc, governance, monitoring, movement, sales
from driftlake.sources import tables as io
from driftlake.sources.versioned import VersionedTable
from driftlake.streaming.apply import absorb, stream_cdc_apply

T = datetime.datetime(2024, 1, 1)
CHANGES = "k long, v string, cdc_action string, cdc_is_update boolean, row_id string"


def _at():
    return F.lit(T).cast("timestamp")


def _shuffled(spark, action):
    """Rows written to shuffles while action runs, and its result."""
    sc = spark.sparkContext
    store, none = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)
    stages = lambda: [(s.stageId(), s.shuffleWriteRecords()) for s in (lambda l: [l.apply(i) for i in range(l.size())])(store.stageList(None, False, False, none, None))]
    first = max([n for n, _ in stages()], default=-1)
    out = action()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(rows for n, rows in stages() if n > first), out


def _table(spark, rows, tmp_path, order=(), **how):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], order, **how)
    table.write(cdc.new_target(spark.createDataFrame(rows, "k long, v string"), _at(), "B0"))
    return table


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """An update of an unknown key is an INSERT, and stays one when its batch comes again."""
    table = _table(spark, [(1, "a")], tmp_path)
    apply = absorb(table, "cdc", _at())
    batch = spark.createDataFrame([(2, "b", "INSERT", True, "r")], CHANGES)
    apply(batch, 0)
    v = table.version()
    apply(batch, 0)
    assert table.version() == v and {r["k"]: r["cdc_operation"] for r in table.read().collect()} == {1: "INSERT", 2: "INSERT"}
    # a batch that failed after its data and before its manifest leaves a folder that no version names
    spark.createDataFrame([(9, "junk")], "k long, v string").write.parquet(str(tmp_path / "t" / "data" / "left-behind"))
    apply(spark.createDataFrame([(3, "c", "INSERT", False, "r")], CHANGES), 1)
    assert sorted(r["k"] for r in table.read().collect()) == [1, 2, 3]
    table.vacuum(1)
    assert not (tmp_path / "t" / "data" / "left-behind").exists() and table.read().count() == 3 and len(table.versions()) == 1


def test_a_batch_writes_as_many_rows_as_it_has_keys(spark, tmp_path):
    table = _table(spark, [(i, "x") for i in range(5000)], tmp_path, bucket_rows=500)
    base = table.manifest()["base"]
    assert base["bits"] == 4 and base["rows"] == 5000
    absorb(table, "cdc", _at())(spark.createDataFrame([(7, "y", "INSERT", True, "r"), (7, "y", "DELETE", True, "r"), (8, "z", "DELETE", False, "r"), (None, "n", "INSERT", False, "r")], CHANGES), 0)
    m = table.manifest()
    assert m["base"] == base and [d["rows"] for d in m["deltas"]] == [2]
    assert table.read(0).where("v = 'y'").count() == 0 and table.read().where("v = 'y'").count() == 1 and table.read().where("is_deleted").count() == 1
    plan = table.read()._jdf.queryExecution().toString()
    assert "prefix#" in plan and "PartitionFilters: [prefix" in plan  # buckets without changes are not joined


def _replayed(start: dict, log: list[tuple]) -> dict:
    """(value, deleted, label) of each key, one change after another by sequence, puts after deletions."""
    rows = {k: (v, False, "INSERT") for k, v in start.items()}
    for k, _, v, action, update, _ in sorted(set(log), key=lambda c: (c[1], c[3] == "INSERT", c[5])):
        if action == "INSERT":
            rows[k] = (v, False, "UPDATE" if update and k in rows else "INSERT")
        elif not update and k in rows:
            rows[k] = (rows[k][0], True, "DELETE")
    return rows


ORDERED = "k long, seq long, v string, cdc_action string, cdc_is_update boolean, row_id string"


@pytest.mark.parametrize("seed", range(4))
def test_any_batches_end_as_a_replay_in_order(spark, tmp_path, seed):
    """Several changes a key in a batch, across batches, late by any number of batches, and repeated; with compactions between."""
    rng = random.Random(seed)
    start = {k: f"s{k}" for k in range(0, 12, 2)}
    log = []
    for seq in range(60):
        action, update = rng.choice([("INSERT", True), ("INSERT", True), ("INSERT", False), ("DELETE", False), ("DELETE", True)])
        log.append((rng.randrange(12), seq // 2 if seed == 3 else seq, f"v{seq}", action, update, f"{seq:03}"))
    table = _table(spark, list(start.items()), tmp_path, ["seq"])
    late = rng.sample(log, len(log))
    batches = [late[i : i + 10] + rng.sample(log, 3) for i in range(0, len(late), 10)]
    for n, batch in enumerate(batches):
        absorb(table, "cdc", _at())(spark.createDataFrame(batch, ORDERED), n)
    got = {r["k"]: (r["v"], r["is_deleted"], r["cdc_operation"]) for r in table.read().collect()}
    assert got == _replayed(start, log)
    assert len(table.manifest()["deltas"]) < len(batches)
    table.compact()
    assert {r["k"]: (r["v"], r["is_deleted"], r["cdc_operation"]) for r in table.read().collect()} == got and not table.manifest()["deltas"]


def test_two_updates_and_an_insert_then_delete_of_one_batch(spark, tmp_path):
    table = _table(spark, [(1, "a")], tmp_path, ["seq"])
    rows = [(1, 2, "new", "INSERT", True, "a"), (1, 1, "old", "INSERT", True, "z"), (2, 1, "b", "INSERT", False, "r"), (2, 2, "b", "DELETE", False, "r"), (3, 1, "c", "DELETE", False, "r")]
    absorb(table, "cdc", _at())(spark.createDataFrame(rows, ORDERED), 0)
    assert {r["k"]: (r["v"], r["is_deleted"]) for r in table.read().collect()} == {1: ("new", False), 2: ("b", True)}
    absorb(table, "cdc", _at())(spark.createDataFrame([(1, 1, "late", "INSERT", True, "zz"), (3, 0, "c", "INSERT", False, "r")], ORDERED), 1)
    assert {r["k"]: (r["v"], r["is_deleted"]) for r in table.read().collect()} == {1: ("new", False), 2: ("b", True), 3: ("c", True)}


def test_a_table_is_opened_as_it_was_made(spark, tmp_path):
    table = _table(spark, [(i, "x") for i in range(300)], tmp_path, bucket_rows=10)
    again = VersionedTable(spark, table.path, ["k"], bucket_rows=1 << 20)
    absorb(again, "cdc", _at())(spark.createDataFrame([(i, "y", "INSERT", True, "r") for i in range(0, 300, 3)], CHANGES), 0)
    rows = again.read().collect()
    assert len(rows) == 300 and sum(r["v"] == "y" for r in rows) == 100
    with pytest.raises(ValueError, match="lack"):
        VersionedTable(spark, str(tmp_path / "o"), ["k"], ["seq"]).write(spark.createDataFrame([(1, "a")], "k long, v string"))
        VersionedTable(spark, str(tmp_path / "o"), ["k"], ["seq"]).append(spark.createDataFrame([(1, "a")], "k long, v string"))
    for wrong in ((["v"], ()), (["k"], ["seq"])):
        with pytest.raises(ValueError, match="has the keys"):
            VersionedTable(spark, table.path, *wrong)


def test_two_writers_of_a_version(spark, tmp_path):
    one = _table(spark, [(1, "a")], tmp_path)
    two = VersionedTable(spark, one.path, ["k"])
    m = two.manifest()
    one.append(spark.createDataFrame([(2, "b", "INSERT", False, "r")], CHANGES), _at())
    with pytest.raises(OSError, match="another writer"):
        two._commit({**m, "version": m["version"] + 1})
    assert sorted(r["k"] for r in one.read().collect()) == [1, 2]


def test_recovery_of_a_table_with_an_order(spark, tmp_path):
    """A reload of what is known already changes no value; rows that the changes missed come back."""
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 7)], "k long, v string, seq long")
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["seq"])
    table.write(cdc.new_target(rows.where("k = 1"), _at(), "B0"))
    table.append(spark.createDataFrame([(1, "c", 9, "INSERT", True, "r")], "k long, v string, seq long, cdc_action string, cdc_is_update boolean, row_id string"), _at(), "B1")
    table.append(cdc.initial_snapshot(rows, ["k"]), _at(), "R", reload=True)
    assert {r["k"]: (r["v"], r["cdc_operation"]) for r in table.read().collect()} == {1: ("c", "UPDATE"), 2: ("b", "INSERT")}


def test_stream_reads_an_empty_source(spark, tmp_path):
    table = _table(spark, [(1, "a")], tmp_path)
    at = str(tmp_path / "changes")
    spark.createDataFrame([], CHANGES).write.parquet(at)
    stream_cdc_apply(spark.readStream.schema(CHANGES).parquet(at), table, str(tmp_path / "c"), None, _at()).awaitTermination()
    assert table.read().count() == 1


def test_stage_validation_is_not_pruned(spark):
    bad = cdc.stage_validation(spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string"), ["k"])
    for use in (lambda: bad.count(), lambda: bad.select("v").collect()):
        with pytest.raises(Exception, match="null in a key"):
            use()


def test_process_all_isolates_failures_at_run_time(spark):
    raising = lambda c: spark.range(3).where(F.raise_error(F.lit("late")).cast("boolean")) if c["table"] == "b" else spark.range(3)
    out = cdc.cdc_process_all([{"table": "a"}, {"table": "b", "priority": 1}], raising, lambda c, df: df.count())
    assert [(r["table"], r["status"], r["result"]) for r in out] == [("b", "ERROR", None), ("a", "SUCCESS", 3)]


def test_anti_contained_is_strict(spark):
    """Equal starts or ends don't contain; strictly inside does, also behind several legs of one start."""
    rows = [(1, 0, 10), (2, 0, 8), (3, 2, 10), (4, 2, 9), (5, 3, 9), (6, 0, 10), (7, 11, 12)]
    legs = spark.createDataFrame([(i, 1, s, e) for i, s, e in rows], "id int, k int, s int, e int")
    got = sorted(r["id"] for r in movement.anti_contained(legs, ["k"], "s", "e").collect())
    assert got == sorted(i for i, s, e in rows if not any(a < s and b > e for _, a, b in rows))


def test_masks_show_least_to_unknown_roles(spark):
    rows = spark.createDataFrame([("123-45-6789", 1234.0), (None, None)], "ssn string, pay double")
    for role in ("GUEST", None):
        seen = rows.select(governance.masked(F.col("ssn"), "ssn", F.lit(role)).alias("s"), governance.masked(F.col("pay"), "salary", F.lit(role)).alias("p"))
        assert [tuple(r) for r in seen.collect()] == [("***-**-****", None)] * 2
    assert rows.select(governance.masked(F.col("ssn"), "ssn", F.lit("HR_ANALYST"))).first()[0] == "***-**-6789"


def test_row_access_all_keeps_null_regions(spark):
    rows = spark.createDataFrame([(1, "A"), (2, None)], "id int, region string")
    grants = spark.createDataFrame([("x", "ALL"), ("x", "A"), ("y", "A")], "role string, allowed_region string")
    ids = lambda role: sorted(r["id"] for r in governance.row_access_filter(rows, role, grants, "region").collect())
    assert (ids("x"), ids("y"), ids("z")) == ([1, 2], [1], [])


def test_role_hierarchy_depth_and_paths(spark):
    edges = spark.createDataFrame([(f"r{i}", f"r{i + 1}") for i in range(12)], "child string, parent string")
    got = {r["steps"]: r["path"] for r in governance.role_hierarchy(edges).where("role = 'r0'").collect()}
    assert sorted(got) == list(range(1, 11)) and got[3] == "r0 -> r2 -> r3"


def test_ntiles_and_row_numbers_agree_with_one_window(spark):
    rows = spark.createDataFrame([(i, i * 7 % 11) for i in range(53)], "id int, v int")
    order = [F.desc("v"), F.col("id")]
    got = {r["id"]: r["t"] for r in sales.ntiles(rows, order, 5, "t").collect()}
    want = {}
    for n, (_, i) in enumerate(sorted((-(i * 7 % 11), i) for i in range(53))):
        want[i] = n // 11 + 1 if n < 33 else 3 + (n - 33) // 10 + 1
    assert got == want


def test_alerts_are_held_back_by_kind(spark):
    now = F.lit(T).cast("timestamp_ntz")
    streams = spark.createDataFrame([("a", "s", "STALE", None), ("b", "s", "ACTIVE", 5.0), ("c", "s", "ACTIVE", 5.0)], "table_name string, stream_name string, stream_status string, hours_until_stale double")
    tasks = spark.createDataFrame([("a", False, None)], "table_name string, is_healthy boolean, last_return_value string")
    ago = lambda h: T - datetime.timedelta(hours=h)
    alerts = spark.createDataFrame([("STREAM_STALE", "a", False, ago(2)), ("STREAM_STALENESS_WARNING", "b", False, ago(3)), ("TASK_FAILURE", "a", True, ago(0.1))], "alert_type string, table_name string, is_acknowledged boolean, created_at timestamp_ntz")
    got = {(r["alert_type"], r["table_name"]) for r in monitoring.generate_alerts(streams, tasks, alerts, now).collect()}
    assert got == {("STREAM_STALE", "a"), ("TASK_FAILURE", "a"), ("STREAM_STALENESS_WARNING", "c")}


def test_json_lines_keep_nulls_and_numbers(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(['{"x": 1}', "null", "{bad", '"s"']))
    rows = io.load_json_landing(spark, str(tmp_path)).select(F.to_json("data").alias("d"), "row_number").collect()
    assert sorted((r["row_number"], r["d"]) for r in rows) == [(1, '{"x":1}'), (2, "null"), (4, '"s"')]


def test_watermark_without_new_rows_stays(spark):
    marks = spark.createDataFrame([("t", T)], "table_name string, watermark timestamp")
    rows, after = cdc.watermark_advance(spark.createDataFrame([(1, T)], "id int, ts timestamp"), "ts", marks, "t")
    assert rows.count() == 0 and after.collect()[0]["watermark"] == T
    assert json.dumps(sorted(after.columns)) == '["table_name", "watermark"]'


def test_hot_keys_are_parted_by_time(spark, monkeypatch):
    """As-of matches and containment with a key of many times over what a task may sort: the same rows as in one window."""
    rng = random.Random(2)
    events = spark.createDataFrame([(i, None if i % 50 == 0 else 1 if i % 3 else i % 5, rng.randrange(400)) for i in range(600)], "e int, k int, t int")
    changes = spark.createDataFrame([(rng.randrange(90), None if i % 50 == 0 else 1 if i % 4 else i % 5, rng.randrange(-20, 400) if i % 40 else None) for i in range(500)], "v int, k int, c int")
    legs = events.selectExpr("e", "k", "t AS s", "t + e % 60 AS z")
    run = lambda: (sorted(map(repr, movement.asof_match(events, changes, ["k"], "e", "t", "c", ["v"]).collect())), sorted(map(repr, movement.anti_contained(legs, ["k"], "s", "z").collect())))
    whole = run()
    monkeypatch.setattr(movement, "SORTED_ROWS", 20)
    assert run() == whole and all(whole)
    rows = legs.collect()
    inside = {r["e"] for r in rows for o in rows if r["k"] == o["k"] and o["s"] < r["s"] and o["z"] > r["z"]}
    assert len(whole[1]) == len(rows) - len(inside)


def test_legs_that_end_before_they_start_conflict_with_nothing(spark):
    legs = spark.createDataFrame([(1, 1, T, T - datetime.timedelta(days=2), "a"), (2, 1, T, T + datetime.timedelta(days=1), "a")], "id int, k int, s timestamp, e timestamp, train string")
    events = spark.createDataFrame([(1, T + datetime.timedelta(hours=3), "b")], "k int, t timestamp, train string")
    assert [r["id"] for r in movement.anti_conflicting(legs, events, ["k"], "s", "e", "t", ("train", "train"), "id").collect()] == [1]


def test_conflicts_of_a_hot_key_make_no_pairs(spark, monkeypatch):
    """As a plain loop finds them, whole and in ranges; no join of legs and events is left."""
    rng = random.Random(7)
    pick = lambda values: rng.choice(values)
    at = lambda: pick([None, *[T + datetime.timedelta(minutes=m) for m in range(40)]])
    legs = [(i, pick([None, 1, 2]), at(), at(), pick([None, "a", "b", "c"])) for i in range(150)]
    legs += [(1, 1, T, T, "a"), (1, 1, T, T, "b")]
    events = [(pick([None, 1, 2]), at(), pick([None, "a", "a", "a", "b", "c"])) for _ in range(60)]
    hit = lambda leg: any(e[0] == leg[1] and None not in (*leg, *e) and leg[2] <= e[1] <= leg[3] and e[2] != leg[4] for e in events)
    want = sorted(map(repr, [leg for leg in legs if not hit(leg)]))
    ours = (spark.createDataFrame(legs, "id int, k int, s timestamp, e timestamp, train string"), spark.createDataFrame(events, "k int, t timestamp, train string"))
    run = lambda: movement.anti_conflicting(*ours, ["k"], "s", "e", "t", ("train", "train"), "id")
    assert sorted(repr(tuple(r)) for r in run().collect()) == want and 10 < len(want) < len(legs) - 10
    monkeypatch.setattr(movement, "_hot", lambda rows, keys: True)
    assert sorted(repr(tuple(r)) for r in run().collect()) == want
    monkeypatch.undo()
    many = spark.range(4000).selectExpr("id", "1 AS k", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS t", "if(id < 0, 'b', 'a') AS train")
    met = movement.anti_conflicting(many.selectExpr("id", "k", "timestamp'2024-01-01' AS s", "t", "train"), many.selectExpr("k", "t AS at", "train"), ["k"], "s", "t", "at", ("train", "train"), "id")
    assert met.count() == 4000
    assert not [p for p in met._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in p]


def test_zones_are_met_without_a_shuffle_of_rows(spark):
    """As a plain loop finds them, with nulls, repeated rows and zones of several buckets; 5,000 rows of one key stay where they are."""
    rng = random.Random(5)
    num = lambda: rng.choice([None, *range(60)])
    zones = sorted({(rng.randrange(3), i % 9, rng.randrange(50), rng.randrange(50)) for i in range(25)})
    rows = [(rng.choice([None, 0, 1, 2, 3]), num(), num()) for _ in range(120)]
    rows += rows[:10]
    holds = lambda x, lo, hi, last: x is not None and (lo <= x < hi or last and x == hi and lo <= x)
    fit = lambda r: [z for z in zones if z[0] == r[0] and (holds(r[1], z[2], z[3], False) or holds(r[2], z[2], z[3], True))]
    want = [(*r, *z[1:]) for r in rows for z in fit(r) or [(None,) * 4]]
    z = spark.createDataFrame(zones, "k int, name int, zlo int, zhi int")
    got = movement.range_zone_join(spark.createDataFrame(rows, "k int, lo int, hi int"), z, "k", "lo", "hi", "zlo", "zhi", 10).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    many = spark.range(5000).selectExpr("1 AS k", "id % 60 AS lo", "id % 60 + 7 AS hi")
    n, _ = _shuffled(spark, lambda: movement.range_zone_join(many, z, "k", "lo", "hi", "zlo", "zhi", 10).write.format("noop").mode("overwrite").save())
    assert n < 1000


def test_miles_are_split_by_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(movement, "TASK_ROWS", 100, raising=False)
    st = spark.range(1000).selectExpr("id AS od_id", "id % 3 AS subdivision_nbr", "'a' AS subdivision_name", "1D AS miles", "true AS is_active")
    br = st.selectExpr("od_id", "subdivision_nbr AS from_nbr", "'a' AS from_name", "subdivision_nbr AS to_nbr", "1D AS low_miles", "2D AS high_miles")
    zones = spark.createDataFrame([(1, "r", "z", "d", 0.0, 9.0)], "subdivision_nbr long, region string, zone string, division string, low_mile double, high_mile double")
    got = movement.od_subdivision_miles(st, br, zones)
    assert got.rdd.getNumPartitions() == 11
    assert got.groupBy("region", "miles").count().where("region is not null").collect() == [("r", 1.0, 333)]


def test_orphans_of_one_place_make_no_pairs(spark):
    """2,000 events and 2,000 changes of one place and time: each event meets what the changes are folded to, and its match."""
    events = spark.range(2000).selectExpr("id", "'a' AS k", "timestamp'2024-01-01' AS t")
    changes = spark.range(2000).selectExpr("'a' AS ck", "timestamp'2024-01-01' AS reported", "id div 2 AS cid", "id % 2 AS version", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id - 1500) AS changed")
    find = lambda: movement.orphan_match(events, changes, {"k": "ck"}, "id", "t", "reported", ("cid", "version"), ["changed"], ["id"]).groupBy("matched_cid", "matched_version").count().collect()
    rows, got = _shuffled(spark, find)
    assert [tuple(r) for r in got] == [(750, 0, 2000)] and rows < 20_000


def test_orphans_with_ties_nulls_and_repeated_rows(spark):
    at = lambda h: T + datetime.timedelta(hours=h)
    events = spark.createDataFrame([(1, "a", "s", at(5)), (1, "a", "s", at(5)), (2, "a", None, at(5)), (3, "a", "s", at(6)), (4, "b", "s", at(5)), (5, "c", "s", at(5))], "id int, k string, station string, t timestamp")
    changes = spark.createDataFrame([("a", "s", at(5), 7, 1, at(1), "old"), ("a", "s", at(5), 7, 2, at(2), "x"), ("a", "s", at(5), 7, 2, at(2), "y"), ("a", "s", at(5), 6, 9, at(1), "less"), ("b", "s", at(5), 1, 1, at(9), "late"), ("b", "s", at(5), 2, 1, at(10), "later"), ("c", None, at(5), 1, 1, at(1), "null")], "ck string, cs string, reported timestamp, cid int, version int, changed timestamp, status string")
    got = movement.orphan_match(events, changes, {"k": "ck", "station": "cs"}, "id", "t", "reported", ("cid", "version"), ["changed", "status"]).collect()
    assert sorted((r["id"], str(r["matched_cid"]), str(r["matched_version"]), str(r["matched_status"])) for r in got) == [(1, "7", "2", "x"), (1, "7", "2", "x"), (1, "7", "2", "y"), (1, "7", "2", "y"), (2, "None", "None", "None"), (3, "None", "None", "None"), (4, "1", "1", "late"), (5, "None", "None", "None")]


def test_a_long_chain_of_roles(spark):
    n = 150_000
    edges = spark.range(n).selectExpr("id AS child", "id + 1 AS parent")
    got = governance.role_hierarchy(edges).groupBy("steps").count().collect()
    assert {r["steps"]: r["count"] for r in got} == {k: n - k + 1 for k in range(1, 11)}


def test_pairs_of_a_closure_are_not_shuffled_in_every_step(spark):
    """All pairs of 60 chains of 20 steps; nothing is left of the tables that were made for them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(1200).selectExpr("id AS child", "id + 60 AS parent")
        rows, got = _shuffled(spark, lambda: governance.role_closure(edges).groupBy("steps").count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert {r["steps"]: r["count"] for r in got} == {k: 60 * (21 - k) for k in range(1, 21)}
    # 20 times the edges, and each pair before its join and after it, but not what was found before
    assert rows < 20 * 1200 + 3 * 12_600 + 10_000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pairs_")]


def test_a_closure_of_no_edges(spark):
    assert governance.role_closure(spark.createDataFrame([], "child long, parent long")).collect() == []


def test_cycles_of_roles_end_and_are_told(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("d", "d"), ("a", None)], "child string, parent string")
    got = {(r["role"], r["ancestor"], r["steps"], r["is_cycle"]) for r in governance.role_hierarchy(edges).collect()}
    assert got == {("a", "b", 1, False), ("a", "c", 2, False), ("a", "b", 3, True), ("b", "c", 1, False), ("b", "b", 2, True), ("c", "b", 1, False), ("c", "c", 2, True), ("d", "d", 1, True)}
    pairs = {(r["role"], r["ancestor"], r["steps"], r["is_cycle"]) for r in governance.role_closure(edges).collect()}
    assert pairs == {("a", "b", 1, False), ("a", "c", 2, False), ("b", "c", 1, False), ("b", "b", 2, True), ("c", "b", 1, False), ("c", "c", 2, True), ("d", "d", 1, True)}
