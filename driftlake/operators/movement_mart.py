"""The nightly movement chain: events to staging, legs to facts, missing lead locomotives, train summary; in full or for late events.

events: event_id, kind (EQPMV or LCMTV), equipment, train (null: unknown), station, code, report_ts (Eastern), zone.
consists: train, equipment, station, change_ts, reported_ts, cnst_id, version, train_name, status, sqnc, tare, net, lead_ind,
loco_status, lead_equipment; a row for each equipment of a consist's version."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.operators.movement import anti_conflicting, anti_contained, asof_match, dst_local_time, movement_legs, orphan_match, train_level_summary
from driftlake.sources.dated import DatedTable

# fixed values: events that move equipment, states of a consist that an event is matched with, and states of a dead locomotive
CODES = ("ARIL", "ARRI", "DFLC", "ICHR", "ICHD")
STATUSES = ("ARRIVED", "DEPARTED", "PASSING-OUT", "PASSING-IN")
DEAD = ("DEAD", "DEADHEAD")
#: Days that a leg lasts at most; longer gaps between two events are none.
LONGEST = 10
_CONSIST = ["cnst_id", "version", "equipment"]


def stage(events: DataFrame, consists: DataFrame) -> DataFrame:
    """Step 1: moving events with the consist that they belong to: as of their time by train and equipment, or, without a train,
    by equipment, station and exact time (and then also those that match nothing). With local time and the train's name."""
    e = events.where(F.col("code").isin(*CODES) & F.col("event_id").isNotNull())
    moved = consists.where(F.col("status").isin(*STATUSES))
    known = asof_match(e.where("train is not null"), moved, ["train", "equipment"], "event_id", "report_ts", "change_ts", ["cnst_id", "version"], ["kind", "station", "code", "zone"])
    lone = orphan_match(e.where("train is null"), moved, {"equipment": "equipment", "station": "station"}, "event_id", "report_ts", "reported_ts", ("cnst_id", "version"), ["change_ts"], None, True)
    rows = known.unionByName(lone.select(*known.columns)).withColumnsRenamed({"matched_cnst_id": "cnst_id", "matched_version": "version"}).withColumn("local_ts", dst_local_time(F.col("report_ts"), F.col("zone")))
    return rows.join(consists.select(*_CONSIST, "train_name"), _CONSIST, "left").select("event_id", "kind", "equipment", "train", "station", "code", "report_ts", "local_ts", "zone", "cnst_id", "version", "train_name")


def facts(staging: DataFrame, consists: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Step 3: a fact for each leg between two stations of a named train, unless another train has moved the equipment meanwhile."""
    legs = movement_legs(staging, ["equipment", "train"], "report_ts", "event_id", ["station", "code", "train", "local_ts"], (), {"train": 0})
    near = F.col("from_report_ts") >= F.col("report_ts") - F.make_dt_interval(F.lit(longest))
    legs = legs.where(near & (F.col("from_code") != "ICHD") & (F.col("from_station") != F.col("station")) & F.col("train_name").isNotNull())
    legs = anti_conflicting(legs, staging.where("train_name is not null"), ["equipment"], "from_report_ts", "report_ts", "report_ts", ("train_name", "train_name"), "event_id", True)
    rows = legs.join(consists.select(*_CONSIST, "sqnc", "tare", "net", "lead_ind", "loco_status", "lead_equipment"), _CONSIST, "left")
    role = F.when(F.col("kind") != "LCMTV", "NA").when(F.col("lead_ind") == "Y", "LD").when(F.col("loco_status").isin(*DEAD), "DH").otherwise("LT")
    return rows.select(
        "event_id", "equipment", "kind", F.coalesce("train", "from_train").alias("train"), "train_name", "cnst_id", "version",
        F.col("from_report_ts").alias("start_ts"), F.col("report_ts").alias("end_ts"), F.col("from_local_ts").alias("start_local_ts"), F.col("local_ts").alias("end_local_ts"),
        F.col("from_station").alias("start_station"), F.col("station").alias("end_station"), F.col("from_code").alias("start_code"), F.col("code").alias("end_code"),
        "sqnc", "tare", "net", role.alias("lead_trail"), "lead_equipment",
    )


def missing_leads(rows: DataFrame, among: DataFrame) -> DataFrame:
    """Step 4: for each train, stretch, consist and day of arrival without a lead locomotive, its first fact once more as that of the
    consist's lead locomotive; not where a fact of among has this locomotive with the same train all the while."""
    by = ["train_name", "train", "start_station", "end_station", "cnst_id", "day"]
    dated = rows.withColumn("day", F.to_date("end_ts"))
    bare = dated.groupBy(*by).agg(F.min("event_id").alias("event_id"), F.count_if(F.col("lead_trail") == "LD").alias("leads")).where("leads = 0")
    first = rows.join(bare.select("event_id"), "event_id", "left_semi").where("lead_equipment is not null")
    led = first.withColumns({"equipment": F.col("lead_equipment"), "kind": F.lit("LCMTV"), "lead_trail": F.lit("LD"), "sqnc": F.coalesce("sqnc", F.lit(1))})
    keys = ["equipment", "train_name"]
    most = rows.where("lead_equipment is not null").select(F.col("lead_equipment").alias("equipment"), "train_name").unionByName(among.select(*keys))
    return anti_contained(led.select(*rows.columns), keys, "start_ts", "end_ts", among, most)


def summary(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Step 5: train_level_summary's measures of each day, train and stretch; measures: the columns that it asks for."""
    keys = ["day_ts", "train", "train_name", "start_station", "end_station"]
    engine = F.when(F.col("kind") == "LCMTV", F.col("equipment"))
    wide = rows.withColumns({"day_ts": F.date_trunc("day", "end_ts"), "role": F.col("lead_trail"), "locomotive_id": engine, **measures})
    return train_level_summary(wide, keys)


class MovementMart:
    """The chain's tables, each in a folder a day, brought up to date by every load's events alone.

    An event of a day D changes facts that arrive from D to `longest` days after, and leads and summaries as many days before
    too; these days are worked out again from staging and facts as far as they reach, all others keep their files. So a late
    event leaves the same tables as a run over all events would. Events of an id that is known replace it where they are of
    its day; consists that come later count for events that come after them."""

    def __init__(self, spark: SparkSession, path: str, longest: int = LONGEST):
        self.spark, self.longest = spark, longest
        self.staging, self.facts, self.leads = (DatedTable(spark, f"{path}/{n}", ts) for n, ts in (("staging", "report_ts"), ("facts", "end_ts"), ("leads", "end_ts")))
        self.summary = DatedTable(spark, f"{path}/summary", "day_ts")

    def _around(self, days: Iterable[datetime.date], before: int, after: int) -> list[datetime.date]:
        return sorted({d + datetime.timedelta(days=k) for d in days for k in range(-before, after + 1)})

    def run(self, events: DataFrame, consists: DataFrame, measures: dict[str, Column]) -> dict[str, list[datetime.date]]:
        """Take in a load's events; the days of each table that were worked out again."""
        n, new = self.longest, self.staging.aside()
        staged = stage(events, consists)
        new.add(staged)
        days = new.days()
        if days:
            old = self.staging.read(staged.schema, days=days)
            new.add(old.join(new.read(staged.schema).select("event_id"), "event_id", "left_anti").select(*staged.columns))
        self.staging.take(new, days)
        if not days:
            return {}
        changed, around = self._around(days, 0, n), self._around(days, n, n)
        rows = facts(self.staging.read(staged.schema, days=around), consists, n)
        self.facts.refresh(rows, changed)
        kept = self.facts.read(rows.schema, days=around)
        led = missing_leads(kept, self.facts.read(rows.schema, days=self._around(days, n, 2 * n)))
        self.leads.refresh(led, around)
        self.summary.refresh(summary(kept.unionByName(self.leads.read(rows.schema, days=around)), measures), around)
        return {"staging": days, "facts": changed, "leads": around, "summary": around}
