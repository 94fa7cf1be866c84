import datetime

import duckdb
import pytest

from driftlake.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    cols = sorted(found.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = [tuple(r[names.index(c)] for c in cols) for r in want.fetchall()]
    assert plain(found.select(*cols).collect()) == plain(rows)


def test_whole_tables_are_sorted(spark):
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    by_case = [(r["severity"], r["o_orderkey"]) for r in QUERIES["order_by_case"](spark, SF).collect()]
    assert len(by_case) == n > 100 and by_case == sorted(by_case)
    by_null = [r["r"] for r in QUERIES["order_nulls_last"](spark, SF).collect()]
    values = [v for v in by_null if v is not None]
    assert len(by_null) == n > len(values) > 22 and by_null == sorted(values, reverse=True) + [None] * (n - len(values))


def test_windows_end_with_the_log(spark, tmp_path):
    """Six errors within a day are an attack, six over weeks aren't; older rows are in no window."""
    t = datetime.datetime(2024, 3, 30, 12)
    rows = [(i, t - datetime.timedelta(hours=i), 1, "error", 2.0 * i) for i in range(6)] + [(10 + i, t - datetime.timedelta(days=3 * i), 2, "error", 1.0) for i in range(6)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    sf = str(tmp_path)
    assert [tuple(r) for r in QUERIES["brute_force_24h"](spark, sf).collect()] == [(1, 6, t - datetime.timedelta(hours=5), t)]
    hours = {r["hour"]: (r["runs"], r["failed"], r["mean_seconds"], r["most_seconds"]) for r in QUERIES["execution_stats_last_24h"](spark, sf).collect()}
    assert len(hours) == 6 and hours[t] == (2, 2, 0.5, 1.0)
    assert {(str(r["day"]), r["user_id"]): (r["runs"], r["mean_value"]) for r in QUERIES["pipeline_trend_last_7d"](spark, sf).collect()} == {("2024-03-30", 1): (6, 5.0), ("2024-03-30", 2): (1, 1.0), ("2024-03-27", 2): (1, 1.0), ("2024-03-24", 2): (1, 1.0)}


def test_facts_are_worked_out_once(spark):
    """Leads and summary read facts three times and more, from a table."""
    from driftlake import movement_queries

    plan = movement_queries._facts(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "parquet" in plan
