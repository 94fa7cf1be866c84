"""The movement chain over the events of the test tables: a query for each step, and one with late events."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlake.operators import movement_mart as mart
from driftlake.registry import Registry
from driftlake.sources.tables import scan, work_dir, written

R = Registry()
_DAYS = 2
_EVENTS = "SELECT event_id, CASE WHEN user_id % 60 % 6 = 0 THEN 'LCMTV' ELSE 'EQPMV' END AS kind, user_id % 60 AS equipment, nullif(user_id % 60 % 4, 0) AS train, event_id % 5 AS station, CASE event_type WHEN 'purchase' THEN 'ARRI' WHEN 'signup' THEN 'ICHD' WHEN 'view' THEN 'ARIL' WHEN 'click' THEN 'DFLC' ELSE 'XXXX' END AS code, ts AS report_ts, {zone} AS zone FROM {events}"
_CONSISTS = "SELECT nullif(user_id % 60 % 4, 0) AS train, user_id % 60 AS equipment, event_id % 5 AS station, ts - INTERVAL '1' HOUR * (event_id % 4) AS change_ts, ts AS reported_ts, event_id {div} 6 AS cnst_id, event_id % 6 {div} 3 + 1 AS version, concat('T', user_id % 60 % 4, '_', event_id {div} 600 % 2) AS train_name, CASE WHEN event_id % 11 = 0 THEN 'PLANNED' ELSE 'ARRIVED' END AS status, event_id % 9 AS sqnc, CAST(event_id % 30 + 1 AS DOUBLE) AS tare, CAST(event_id % 50 AS DOUBLE) AS net, CASE WHEN event_id % 4 = 0 THEN 'Y' ELSE 'N' END AS lead_ind, CASE WHEN event_id % 5 = 0 THEN 'DEAD' ELSE 'LIVE' END AS loco_status, user_id % 10 * 6 AS lead_equipment FROM {events} WHERE event_id % 3 = 0"
_S = f"""WITH e AS ({_EVENTS.format(zone="'ET'", events="events")}), c AS ({_CONSISTS.format(div="//", events="events").replace("INTERVAL '1' HOUR", "INTERVAL 1 HOUR").replace("(event_id % 4) AS change_ts", "CAST(event_id % 4 AS INTEGER) AS change_ts")}),
m AS (SELECT * FROM e WHERE code <> 'XXXX'), a AS (SELECT * FROM c WHERE status = 'ARRIVED'),
f AS (SELECT train, equipment, arg_min(cnst_id * 10 + version, (change_ts, -cnst_id * 10 - version)) AS v FROM a WHERE train IS NOT NULL GROUP BY 1, 2),
b AS (SELECT m.event_id, max(a.cnst_id * 10 + a.version) AS v FROM m JOIN a ON a.train = m.train AND a.equipment = m.equipment AND a.change_ts <= m.report_ts GROUP BY 1),
o AS (SELECT m.event_id, max(a.cnst_id * 10 + a.version) AS v FROM m LEFT JOIN a ON a.equipment = m.equipment AND a.station = m.station AND a.reported_ts = m.report_ts WHERE m.train IS NULL GROUP BY 1),
x AS (SELECT m.event_id, coalesce(b.v, f.v) AS v FROM m JOIN f ON f.train = m.train AND f.equipment = m.equipment LEFT JOIN b ON b.event_id = m.event_id UNION ALL SELECT event_id, v FROM o),
s AS (SELECT m.*, x.v // 10 AS cnst_id, x.v % 10 AS version, c.train_name FROM m JOIN x ON x.event_id = m.event_id LEFT JOIN c ON c.cnst_id = x.v // 10 AND c.version = x.v % 10 AND c.equipment = m.equipment)"""
_F = f"""{_S}, w AS (SELECT *, lag(report_ts) OVER k AS start_ts, lag(station) OVER k AS start_station, lag(code) OVER k AS start_code FROM s WINDOW k AS (PARTITION BY equipment, coalesce(train, 0) ORDER BY report_ts, event_id)),
fact AS (SELECT w.event_id, w.equipment, w.kind, w.train, w.train_name, w.cnst_id, w.version, w.start_ts, w.report_ts AS end_ts, w.start_station, w.station AS end_station, w.start_code, w.code AS end_code, c.sqnc, c.tare, c.net, CASE WHEN w.kind <> 'LCMTV' THEN 'NA' WHEN c.lead_ind = 'Y' THEN 'LD' WHEN c.loco_status = 'DEAD' THEN 'DH' ELSE 'LT' END AS lead_trail, c.lead_equipment
    FROM w LEFT JOIN c ON c.cnst_id = w.cnst_id AND c.version = w.version AND c.equipment = w.equipment
    WHERE w.start_ts >= w.report_ts - INTERVAL {_DAYS} DAY AND w.start_code <> 'ICHD' AND w.start_station <> w.station AND w.train_name IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM s z WHERE z.equipment = w.equipment AND z.report_ts BETWEEN w.start_ts AND w.report_ts AND z.train_name <> w.train_name))"""
_L = f"""{_F}, g AS (SELECT min(event_id) AS event_id FROM fact GROUP BY train_name, train, start_station, end_station, cnst_id, CAST(end_ts AS DATE) HAVING count(*) FILTER (lead_trail = 'LD') = 0),
led AS (SELECT * REPLACE (lead_equipment AS equipment, 'LCMTV' AS kind, 'LD' AS lead_trail, coalesce(sqnc, 1) AS sqnc) FROM fact q WHERE event_id IN (SELECT event_id FROM g) AND lead_equipment IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fact z WHERE z.equipment = q.lead_equipment AND z.train_name = q.train_name AND z.start_ts < q.start_ts AND z.end_ts > q.end_ts))"""
_ROWS = ["event_id", "equipment", "kind", "train", "train_name", "cnst_id", "version", "start_ts", "end_ts", "start_station", "end_station", "start_code", "end_code", "sqnc", "tare", "net", "lead_trail"]
_T = f"""{_L}, r AS (SELECT *, abs(end_station - start_station) * 10 AS miles FROM (SELECT * FROM fact UNION ALL SELECT * FROM led))
SELECT date_trunc('day', end_ts)::TIMESTAMP AS day_ts, train, train_name, start_station, end_station, count(*) FILTER (lead_trail = 'NA') AS cars_total, count(*) FILTER (lead_trail IN ('LD', 'LT')) AS live_loco_count, sum(CASE WHEN lead_trail = 'LD' THEN miles ELSE 0 END)::DOUBLE AS train_miles, sum(net * miles)::DOUBLE AS content_ton_miles FROM r GROUP BY 1, 2, 3, 4, 5"""
_SUMMED = ["day_ts", "train", "train_name", "start_station", "end_station", "cars_total", "live_loco_count", "train_miles", "content_ton_miles"]


def _tables(spark, sf):
    events = scan(spark, sf, "events")
    zone = "element_at(array('PT', 'MT', 'CT', 'ET', 'ST'), CAST(user_id % 5 + 1 AS INT))"
    return spark.sql(_EVENTS.format(zone=zone, events="{events}"), events=events), spark.sql(_CONSISTS.format(div="div", events="{events}"), events=events)


def _measures():
    nothing = F.lit(0.0)
    miles = F.abs(F.col("end_station") - F.col("start_station")) * 10.0
    return {"group_code": F.lit("CAR"), "car_code": F.lit("B100"), "content_tons": F.col("net"), "tare_tons": F.col("tare"), "full_weight": F.lit(None).cast("double"), "horsepower": nothing, "miles": miles, "car_inches": nothing, "loco_inches": nothing}


def _facts(spark, sf):
    events, consists = _tables(spark, sf)
    staging = written(mart.stage(events, consists), "staging")
    return written(mart.facts(staging, consists, _DAYS), "facts")


def movement_stage(spark, sf):
    return mart.stage(*_tables(spark, sf)).drop("local_ts", "zone")


def movement_facts(spark, sf):
    return _facts(spark, sf).select(*_ROWS)


def movement_leads(spark, sf):
    rows = _facts(spark, sf)
    return mart.missing_leads(rows, rows).select(*_ROWS)


def movement_summary(spark, sf):
    rows = _facts(spark, sf)
    return mart.summary(rows.unionByName(mart.missing_leads(rows, rows)), _measures()).select(*_SUMMED)


def movement_chain_late(spark, sf):
    """The chain's summary after a load of most events and one of those that came late, of which some were known."""
    events, consists = _tables(spark, sf)
    chain = mart.MovementMart(spark, work_dir(spark, "mart"), _DAYS)
    for part in ("event_id % 13 <> 5", "event_id % 13 = 5 or event_id % 13 = 6"):
        chain.run(events.where(part), consists, _measures())
    return chain.summary.read().select(*_SUMMED)


R.add("movement_stage", movement_stage, f"{_S} SELECT * EXCLUDE (zone) FROM s")
R.add("movement_facts", movement_facts, f"{_F} SELECT {', '.join(_ROWS)} FROM fact")
R.add("movement_leads", movement_leads, f"{_L} SELECT {', '.join(_ROWS)} FROM led")
R.add("movement_summary", movement_summary, _T)
R.add("movement_chain_late", movement_chain_late, _T)
