import os
import random

from driftlake import movement_queries as q
from driftlake.operators import movement
from driftlake.operators import movement_mart as mart

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_late_loads_leave_what_one_load_leaves(spark, tmp_path):
    """Loads in time, then late ones, a day's events again, and nothing at all; days out of reach keep their files."""
    events, consists = q._tables(spark, SF)
    full = mart.MovementMart(spark, str(tmp_path / "full"), 2)
    full.run(events, consists, q._measures())
    chain = mart.MovementMart(spark, str(tmp_path / "parts"), 2)
    loads = ("event_id % 10 <> 3 and report_ts < timestamp_ntz'2024-01-12'", "event_id % 10 <> 3 and report_ts >= timestamp_ntz'2024-01-11'", "event_id % 10 = 3 and event_id > 40", "event_id < 0")
    for part in loads:
        done = chain.run(events.where(part), consists, q._measures())
    assert done == {}
    last = events.where("event_id % 10 = 3 and event_id <= 40 and code <> 'XXXX'")
    before = _files(tmp_path / "parts" / "facts")
    days = chain.run(last, consists, q._measures())
    for name in ("staging", "facts", "leads", "summary"):
        assert _rows(getattr(chain, name).read()) == _rows(getattr(full, name).read())
    kept = {f for f in before if f.split("on_day=")[1][:10] not in {d.isoformat() for d in days["facts"]}}
    assert kept and kept <= _files(tmp_path / "parts" / "facts")


def test_the_chain_without_events(spark, tmp_path):
    events, consists = q._tables(spark, SF)
    assert mart.MovementMart(spark, str(tmp_path), 2).run(events.limit(0), consists, q._measures()) == {}
    assert mart.facts(mart.stage(events.limit(0), consists), consists).count() == 0


def test_events_are_matched_where_they_stand(spark):
    """No join brings matches back to events, so that rows of one id keep their own ones; of the earliest changes the greatest counts."""
    events, consists = q._tables(spark, SF)
    staged = mart.stage(events, consists)
    assert staged._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    event = spark.sql("select 7L as event_id, 'EQPMV' as kind, 1L as equipment, train, 3L as station, 'ARRI' as code, timestamp_ntz'2024-01-05' + make_dt_interval(d) as report_ts, 'ET' as zone from values (2L, 0), (2L, 3), (2L, -3), (cast(null as bigint), 0) as v(train, d)")
    consist = spark.sql("select 2L as train, 1L as equipment, 3L as station, timestamp_ntz'2024-01-04' + make_dt_interval(d) as change_ts, timestamp_ntz'2024-01-05' as reported_ts, c as cnst_id, 1L as version, 'T' || c as train_name, 'ARRIVED' as status from values (0, 4L), (0, 5L), (3, 6L) as v(d, c)")
    got = sorted((str(r["train"]), r["report_ts"].day, r["train_name"]) for r in mart.stage(event, consist).collect())
    assert got == [("2", 2, "T5"), ("2", 5, "T5"), ("2", 8, "T6"), ("None", 5, "T5")]


def test_legs_are_not_worked_out_to_be_counted(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(movement, "_hot", lambda rows, *how: counted.append(rows._jdf.queryExecution().optimizedPlan().toString()) or False)
    events, consists = q._tables(spark, SF)
    staging = mart.stage(events, consists)
    counted.clear()
    mart.facts(spark.createDataFrame([], staging.schema), consists)
    assert len(counted) == 1 and "Window" not in counted[0]


def test_staging_of_hot_keys_is_parted(spark, monkeypatch):
    events, consists = q._tables(spark, SF)
    whole = _rows(mart.stage(events, consists))
    monkeypatch.setattr(movement, "_hot", lambda rows, *how: True)
    assert _rows(mart.stage(events, consists)) == whole


def test_missing_leads_are_worked_out_once(spark, monkeypatch):
    """Neither to be counted nor to be joined back: facts are read for the first ones, for their trains and to lie in, and joined once."""
    counted = []
    monkeypatch.setattr(movement, "_hot", lambda rows, *how: counted.append(rows._jdf.queryExecution().optimizedPlan().toString()) or False)
    rows = q._facts(spark, SF)
    counted.clear()
    plan = mart.missing_leads(rows, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert len(counted) == 1 and "Join " not in counted[0] and "Aggregate " not in counted[0]
    assert plan.count("Relation ") == 3 and plan.count("Join ") == 1


def test_legs_inside_others(spark, monkeypatch):
    """As a plain loop finds them, in one order, over distinct starts, and in ranges: repeated rows, null keys and ends, and starts and ends that others share."""
    rng = random.Random(11)
    pick = lambda n: [(i % 45, rng.choice([None, 1, 1, 2]), s := rng.randrange(30), rng.choice([None, *range(s, s + 9)]), "x") for i in range(n)]
    legs, others = pick(90), pick(60)
    inside = lambda r: any(o[1] == r[1] and o[2] < r[2] and None not in (o[3], r[3]) and o[3] > r[3] for o in others)
    want = sorted(map(repr, [r for r in legs if not inside(r)]))
    assert 20 < len(want) < 80
    ours = [spark.createDataFrame(r, "id int, k int, s int, e int, more string") for r in (legs, others)]
    run = lambda *most: sorted(repr(tuple(r)) for r in movement.anti_contained(ours[0], ["k"], "s", "e", ours[1], *most).collect())
    assert run() == want
    answers = iter([True, False, True, True])
    monkeypatch.setattr(movement, "_hot", lambda rows, *how: next(answers))
    assert run() == want and run(ours[0].select("k")) == want
