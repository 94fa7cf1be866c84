"""Movement analytics: match events to states as of a time, pair events into legs, drop conflicting ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.sources.tables import work_dir, written


#: Rows of one key that one task may sort; keys with more are parted by time.
SORTED_ROWS = 1 << 21
#: Stretches whose join one task sorts, about.
TASK_ROWS = 1 << 18


def _hot(rows: DataFrame, keys: Sequence[str], times: int = 1) -> bool:
    """Whether any key has more than SORTED_ROWS rows (times each of rows), from counts; an input of few bytes isn't counted."""
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if times * int(size) <= 8 * SORTED_ROWS:
        return False
    return times * (rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > SORTED_ROWS


def _parted(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows written in ranges of their keys and order, with the number of the range: a key with many rows has several, and rows of
    one place in the order are together."""
    path = work_dir(rows.sparkSession, "ranges")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, *keys, *order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _carried(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """What each range of a key takes over from those before it: keys, `__part` and the greatest value there (`__carry`)."""
    per = rows.groupBy(*keys, "__part").agg(F.max(value).alias("__most"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*keys, "__part", F.max("__most").over(before).alias("__carry"))


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """left's columns and right's others, by keys of which nulls are equal."""
    named = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    return left.join(named, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]), how).drop(*[f"__k{i}" for i in range(len(keys))])


def asof_match(events: DataFrame, changes: DataFrame, keys: Sequence[str], event_id: str, event_ts: str, change_ts: str, version: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Each event (with its columns of carry) with the greatest version among changes of its keys at or before it, else of the earliest change.

    Both sides stand in one order by key and time, and a running maximum tells, so that hot keys make no pairs. Where a key has more
    rows than a task may sort (SORTED_ROWS), its times are parted into ranges, each takes over the maximum of those before it
    and has a task of its own. Events without any change of their keys are left out."""
    v = F.struct(*version)
    left = events.select(*keys, F.col(event_ts).alias("__t"), F.lit(1).alias("__side"), F.struct(event_id, *carry).alias("__e"), F.lit(None).cast(changes.select(v.alias("v")).schema["v"].dataType).alias("__v"))
    right = changes.select(*keys, F.col(change_ts).alias("__t"), F.lit(0).alias("__side"), v.alias("__v"))
    rows = left.unionByName(right, True)
    order = lambda by: Window.partitionBy(*by).orderBy("__t", "__side", F.desc("__v"))
    back = lambda by: order(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if _hot(rows, keys):
        rows = _parted(rows, keys, ["__t", "__side"])
        first = rows.where("__side = 0 and __t is not null").groupBy(*keys, "__t").agg(F.max("__v").alias("__v")).groupBy(*keys).agg(F.min_by("__v", "__t").alias("__f"), F.min("__t").alias("__first"))
        taken = _beside(_carried(rows, keys, "__v"), first, keys)
        rows = rows.withColumn("__m", F.max("__v").over(back([*keys, "__part"])))
        rows = _beside(rows, taken, [*keys, "__part"]).withColumn("__m", F.greatest("__m", "__carry"))
    else:
        # the first change in this order is the greatest of the earliest ones, so that one sort and one pass tell both
        whole = order(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        change = F.when((F.col("__side") == 0) & F.col("__t").isNotNull(), F.struct("__t", "__v"))
        rows = rows.withColumns({"__m": F.max("__v").over(back(keys)), "__one": F.first(change, True).over(whole)}).withColumns({"__first": F.col("__one.__t"), "__f": F.col("__one.__v")})
    best = F.coalesce("__m", "__f")
    return rows.where("__side = 1 and __first is not null").select(*keys, F.col("__e")[event_id].alias(event_id), F.col("__t").alias(event_ts), *[F.col("__e")[c].alias(c) for c in carry], *[best[c].alias(f"matched_{c}") for c in version])


def orphan_match(events: DataFrame, changes: DataFrame, on: dict[str, str], event_id: str, event_ts: str, change_ts: str, rank: tuple[str, str], carry: Sequence[str] = (), within: Sequence[str] | None = (), once: bool = False) -> DataFrame:
    """Events with the change that has exactly their time and equal columns of on (event's: change's), or with nulls if there is none.

    Of several the greatest id stays, and of that the greatest version (rank: id and version); a null one only among nulls. A change is
    left aside whose own time, carry[0], is after the event, unless it is the least of all changes that events of the same
    `within` columns met (all columns of on, if none are named; None: that the event itself met). Ties stay side by side, and so do
    repeated rows; once: each event stands once, with id and version alone, which needs no second meeting.
    Changes of one place are folded first, so that an event meets one row of them and then only those that it is matched with."""
    ident, version = rank
    columns = list(dict.fromkeys([ident, version, *carry]))
    at = [*[f"__c{i}" for i in range(len(on))], "__ct"]
    c = changes.select(*[F.col(v).alias(f"__c{i}") for i, v in enumerate(on.values())], F.col(change_ts).alias("__ct"), *[F.col(x).alias(f"matched_{x}") for x in columns])
    equal = reduce(Column.__and__, [F.col(k) == F.col(f"__c{i}") for i, k in enumerate(on)], F.col(event_ts) == F.col("__ct"))
    which = F.struct(F.col(f"matched_{ident}").alias("i"), F.col(f"matched_{version}").alias("v"))
    # changes of one place, folded before events meet them: the greatest that is not after its time, and of the least ones
    if carry:
        own = F.col(f"matched_{carry[0]}")
        early = own.isNull() | (F.col("__ct") >= own)
        places = c.groupBy(*at, own.alias("__own")).agg(F.max(which).alias("__which"), F.max(early).alias("__early"))
        places = places.groupBy(*at).agg(F.max(F.when(F.col("__early"), F.col("__which"))).alias("__fit"), F.min("__own").alias("__own"), F.min_by("__which", "__own").alias("__of_own"))
        met = events.join(places.withColumn("__met", F.lit(True)), equal, "left").drop(*at)
        if within is None:
            met = met.withColumn("__least", F.col("__own"))
        else:
            by = list(within or on)
            met = _beside(met, met.groupBy(*by).agg(F.min("__own").alias("__least")), by)
        top = F.greatest("__fit", F.when(F.col("__own") == F.col("__least"), F.col("__of_own")))
        taken = early | (own == F.col("__least"))
    else:
        met = events.join(c.groupBy(*at).agg(F.max(which).alias("__fit")).withColumn("__met", F.lit(True)), equal, "left").drop(*at)
        top, taken = F.col("__fit"), F.lit(True)
    met = met.withColumn("__top", top).where(F.col("__met").isNull() | F.col("__top").isNotNull())
    if once:
        return met.select(*events.columns, F.col("__top.i").alias(f"matched_{ident}"), F.col("__top.v").alias(f"matched_{version}"))
    same = F.col(f"matched_{ident}").eqNullSafe(F.col("__top.i")) & F.col(f"matched_{version}").eqNullSafe(F.col("__top.v"))
    return met.join(c, equal & same & taken, "left").select(*events.columns, *[f"matched_{x}" for x in columns])


def movement_legs(events: DataFrame, keys: Sequence[str], ts: str, tie: str, carry: Sequence[str], ahead: Sequence[str] = (), unknown: dict[str, object] | None = None) -> DataFrame:
    """Successive events of the same keys as legs: the earlier event's time and columns beside the later's.

    ahead: columns of which the next event's value stands beside too; unknown: what a null key counts as."""
    by = [F.coalesce(k, F.lit(unknown[k])) if unknown and k in unknown else F.col(k) for k in keys]
    w = Window.partitionBy(*by).orderBy(ts, tie)
    beside = {f"from_{c}": F.lag(c).over(w) for c in (ts, *carry)} | {f"next_{c}": F.lead(c).over(w) for c in ahead}
    return events.withColumns(beside).where(F.col(f"from_{ts}").isNotNull())


def _last_two(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with the last event (`__v` at `__t`, where that isn't null) up to each of them in an order of time, the last before it of another
    value (`__last` and `__other`), and their number."""
    w = Window.partitionBy(*by).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = F.when(F.col("__v").isNotNull(), F.struct("__t", "__v"))
    rows = rows.withColumns({"__last": F.last(told, True).over(run), "__was": F.last(told, True).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    turned = F.when(F.col("__v") != F.col("__was.__v"), F.col("__was"))
    return rows.withColumns({"__other": F.last(turned, True).over(run), "__n": F.row_number().over(w)}).drop("__was")


def anti_conflicting(legs: DataFrame, events: DataFrame, keys: Sequence[str], start: str, end: str, ts: str, differs: tuple[str, str], leg_id: str = "", of_events: bool = False) -> DataFrame:
    """Legs during which no event of the same keys has another value of differs (leg's column, event's column). Each leg is judged by
    itself, also where several have one leg_id.

    Events and the ends of legs stand in one order by key and time: the last event up to a leg's end tells, or, if that has the leg's value, the last
    one before it of another. So legs and events make no pairs. Where a key has more rows than a task may sort (SORTED_ROWS), its times are
    parted into ranges that take over both from those before. A leg that ends before it starts has no time in it.
    of_events: each leg is of another one of events and has its keys, so that counts of events tell how many rows a key has at most."""
    told = events.select(*keys, F.col(ts).alias("__t"), F.lit(0).alias("__side"), F.col(differs[1]).alias("__v"))
    told = told.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, "__t", "__v")]))
    rows = told.unionByName(legs.select(*keys, F.col(end).alias("__t"), F.lit(1).alias("__side"), F.struct(*legs.columns).alias("__leg")), True)
    last, other, own = F.col("__last"), F.col("__other"), F.col("__leg")[differs[0]]
    if _hot(told, keys, 2) if of_events else _hot(rows, keys):
        rows = _last_two(_parted(rows, keys, ["__t", "__side"]), [*keys, "__part"], ["__t", "__side"])
        ends = rows.groupBy(*keys, "__part").agg(F.max_by(F.array("__other", "__last"), "__n").alias("__two"))
        two = ends.select(*keys, "__part", F.posexplode("__two").alias("__at", "__e")).select(*keys, "__part", "__at", "__e.*")
        two = _last_two(two, keys, ["__part", "__at"]).where("__at = 1")
        before = Window.partitionBy(*keys).orderBy("__part")
        carry = two.select(*keys, "__part", F.lag("__last").over(before).alias("__last0"), F.lag("__other").over(before).alias("__other0"))
        rows = _beside(rows, carry, [*keys, "__part"])
        taken = F.when(last.isNull(), F.col("__other0")).when(F.col("__last0.__v") != F.col("__last.__v"), F.col("__last0")).otherwise(F.col("__other0"))
        rows = rows.withColumns({"__other": F.coalesce(other, taken), "__last": F.coalesce(last, "__last0")})
    else:
        rows = _last_two(rows, keys, ["__t", "__side"])
    hit = own.isNotNull() & (F.col("__leg")[start] <= F.when(last["__v"] != own, last["__t"]).otherwise(other["__t"]))
    return rows.where((F.col("__side") == 1) & ~F.coalesce(hit, F.lit(False))).select("__leg.*")


def anti_contained(legs: DataFrame, keys: Sequence[str], start: str, end: str, among: DataFrame | None = None, most: DataFrame | None = None) -> DataFrame:
    """Legs that lie strictly inside no other leg (of among, if given) of the same keys: with starts in order, a running maximum of the ends of
    those that start earlier tells. Legs of one start, or one end, don't contain each other.

    Others to lie in stand in one order with the legs, each after the legs of its start, so that legs are worked out once and nothing is joined
    back. With many rows of a key the maximum runs over the distinct starts, each with its latest end; where a key has
    more of them than a task may sort (SORTED_ROWS), they are parted into ranges that take over the maximum of those before.
    most: rows with the keys, of which a key has at least as many as legs and among have together; they are counted instead of these."""
    if among is not None:
        told = among.select(*keys, start, F.col(end).alias("__z"), F.lit(1).alias("__side"))
        both = legs.withColumns({"__z": F.lit(None).cast(among.schema[end].dataType), "__side": F.lit(0)}).unionByName(told, True)
        if not _hot(both.select(*keys) if most is None else most, keys):
            run = Window.partitionBy(*keys).orderBy(start, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            rows = both.withColumn("__m", F.max("__z").over(run)).where("__side = 0")
            return rows.where(F.col("__m").isNull() | F.col(end).isNull() | (F.col("__m") <= F.col(end))).select(*legs.columns)
        legs = written(legs, "legs")
    if among is None and not _hot(legs.select(*keys), keys):
        w = Window.partitionBy(*keys).orderBy(start)
        before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
        rows = legs.withColumns({"__m": before, "__n": F.row_number().over(w)})
        # of legs of one start the first has seen none of the others
        first = F.first("__m").over(Window.partitionBy(*keys, start).orderBy("__n"))
        return rows.withColumn("__m", first).where(F.col("__m").isNull() | F.col(end).isNull() | (F.col("__m") <= F.col(end))).drop("__m", "__n")
    others = legs.select(*keys, start, F.col(end).alias("__z"))
    if among is not None:
        others = others.withColumn("__z", F.lit(None).cast(legs.schema[end].dataType)).unionByName(among.select(*keys, start, F.col(end).alias("__z")))
    ends = others.groupBy(*keys, start).agg(F.max("__z").alias("__end"))
    before = lambda by: F.max("__end").over(Window.partitionBy(*by).orderBy(start).rowsBetween(Window.unboundedPreceding, -1))
    if _hot(ends, keys):
        ends = _parted(ends, keys, [start])
        carry = _carried(ends, keys, "__end")
        ends = ends.withColumn("__m", before([*keys, "__part"]))
        ends = _beside(ends, carry, [*keys, "__part"]).select(*keys, start, F.greatest("__m", "__carry").alias("__m"))
    else:
        ends = ends.select(*keys, start, before(keys).alias("__m"))
    rows = _beside(legs, ends, [*keys, start], "left")
    return rows.where(F.col("__m").isNull() | F.col(end).isNull() | (F.col("__m") <= F.col(end))).drop("__m")


def range_zone_join(rows: DataFrame, zones: DataFrame, key: str, low: str, high: str, zone_low: str, zone_high: str, span: int) -> DataFrame:
    """Rows with the zones of their key whose range holds their low end (the zone's high end aside), or their high end.

    A row meets the zones of its key in the buckets of `span` that its ends lie in, as a list for each bucket (which holds what such a
    bucket has of zones); rows without a zone stay. The lists are written first, so that Spark knows their size: where they are small, rows aren't
    shuffled by the few keys and buckets that many of them share."""
    bucket = lambda c: F.floor(c / span)
    extra = [c for c in zones.columns if c != key]
    spread = zones.distinct().withColumn("__b", F.explode(F.sequence(bucket(F.col(zone_low)), bucket(F.col(zone_high)))))
    lists = written(spread.groupBy(key, "__b").agg(F.collect_list(F.struct(*extra)).alias("__z")), "zones")
    for end in (low, high):
        near = lists.select(F.col(key).alias("__k"), "__b", F.col("__z").alias(f"__of_{end}"))
        rows = rows.join(near, (F.col(key) == F.col("__k")) & (bucket(F.col(end)) == F.col("__b")), "left").drop("__k", "__b")
    at, to = F.col(low), F.col(high)
    fits = lambda z: (at >= z[zone_low]) & (at < z[zone_high]) | (to >= z[zone_low]) & (to <= z[zone_high])
    # of the high end's zones those that the low end's bucket hasn't
    met = lambda z: F.coalesce(bucket(at).between(bucket(z[zone_low]), bucket(z[zone_high])), F.lit(False))
    found = [F.filter(f"__of_{low}", fits), F.filter(f"__of_{high}", lambda z: fits(z) & ~met(z))]
    both = F.concat(*[F.coalesce(f, F.array().cast(lists.schema["__z"].dataType)) for f in found])
    return rows.withColumn("__z", F.explode_outer(both)).drop(f"__of_{low}", f"__of_{high}").select("*", *[F.col("__z")[c].alias(c) for c in extra]).drop("__z")


def od_subdivision_miles(stretches: DataFrame, breakdown: DataFrame, zones: DataFrame, span: int = 100) -> DataFrame:
    """Miles of each origin and destination (od_id) split over subdivisions, with their zone.

    stretches: od_id, subdivision_nbr, subdivision_name, miles, is_active; breakdown: od_id, from_nbr, from_name, to_nbr, low_miles,
    high_miles; zones: subdivision_nbr, region, zone, division, low_mile, high_mile. A subdivision that occurs once keeps
    its miles; others have the part of them inside the zone, never below 0 or above the whole."""
    own = stretches.where("is_active").groupBy("od_id", "subdivision_nbr", "subdivision_name").agg(F.sum("miles").alias("miles"))
    own = own.withColumns({"subdivision_name": F.coalesce("subdivision_name", F.lit("X")), "subdivision_nbr": F.coalesce("subdivision_nbr", F.lit(0))})
    ends = breakdown.where("from_nbr = to_nbr").groupBy("od_id", "from_nbr", "from_name").agg(F.min("low_miles").alias("least"), F.max("high_miles").alias("most"))
    ends = ends.withColumnRenamed("from_nbr", "subdivision_nbr")
    # as many tasks as there are rows for: Spark would put together what compresses well
    n = 1 + stretches.count() // TASK_ROWS
    both = own.repartition(n, "od_id", "subdivision_nbr").join(ends.repartition(n, "od_id", "subdivision_nbr"), ["od_id", "subdivision_nbr"], "left")
    met = range_zone_join(both, zones, "subdivision_nbr", "least", "most", "low_mile", "high_mile", span)
    miles, least, low, high = (F.col(c) for c in ("miles", "least", "low_mile", "high_mile"))
    turned = F.abs(F.abs(high - miles) - miles)
    first = F.when(F.abs(high - least) > miles, F.least(miles, turned)).otherwise(F.abs(high - least))
    rest = F.abs(F.abs(low - least) - miles)
    alone = F.count("*").over(Window.partitionBy("od_id", "subdivision_nbr")) == 1
    part = F.when(alone, miles).when((least >= low) & (least <= high), first).otherwise(F.when(rest > miles, 0).otherwise(rest))
    return met.withColumn("part", part).select("od_id", "subdivision_nbr", "subdivision_name", "region", "zone", "division", F.col("part").alias("miles"))


def dst_local_time(ts: Column, zone: Column) -> Column:
    """Local clock time from Eastern standard time by fixed rules: summer from the second Sunday of March, 05:00, to the
    first Sunday of November, 04:00. ST is always an hour back; other zones have none."""
    def sunday(month: int, extra: int) -> Column:
        return F.date_add(F.next_day(F.date_sub(F.make_date(F.year(ts), F.lit(month), F.lit(1)), 1), "SUN"), extra).cast("timestamp_ntz")

    summer = (ts >= sunday(3, 7) + F.expr("INTERVAL 5 HOURS")) & (ts <= sunday(11, 0) + F.expr("INTERVAL 4 HOURS"))
    # fixed values: hours by zone, in summer and otherwise
    hours = {"PT": (-2, -3), "MT": (-1, -2), "CT": (0, -1), "ET": (1, 0)}
    shift = F.when(zone == "ST", F.lit(-1))
    for z, (warm, cold) in hours.items():
        shift = shift.when(zone == z, F.when(summer, warm).otherwise(cold))
    return ts + F.make_dt_interval(F.lit(0), shift)


def diff_boundary(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of unit crossed, not whole units elapsed."""
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def train_level_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Measures of each train leg from a row for each car or locomotive in it, in one aggregation.

    rows: keys, role (LD leading, LT trailing, DH dead in train, NA a car), locomotive_id, group_code, car_code, content_tons,
    tare_tons, full_weight (pounds), horsepower, miles, car_inches, loco_inches. Missing amounts count as 0; a full weight goes before tare tons."""
    zero = F.lit(0.0)
    amount = lambda c: F.coalesce(F.col(c).cast("double"), zero)
    role, code, miles = F.col("role"), F.col("car_code"), amount("miles")
    car, lead, dead, live = role == "NA", role == "LD", role == "DH", role.isin("LD", "LT")
    content, power, heavy = amount("content_tons"), amount("horsepower"), F.col("full_weight").cast("double") / 2000
    tare = F.coalesce(heavy, amount("tare_tons"))
    revenue = car & ~F.left(code, F.lit(1)).isin("M", "D")
    total = lambda value, of=None: F.coalesce(F.sum(value if of is None else F.when(of, value)), zero)
    measures = {
        "live_unit": F.count_if((F.coalesce("locomotive_id", F.lit(0)) > 0) & (F.coalesce("group_code", F.lit("")) != "EOTD")),
        "cars_loaded": F.count_if(content > 0),
        "cars_total": F.count_if(car),
        "live_loco_count": F.count(F.when(live, F.col("locomotive_id"))),
        "dh_loco_count": F.count(F.when(dead, F.col("locomotive_id"))),
        "eqpmt_miles": total(miles, car),
        "train_miles": total(miles, lead),
        "live_loco_miles": total(miles, live),
        "dh_loco_miles": total(miles, dead),
        "rev_car_miles_loaded": total(miles, revenue & (F.col("content_tons") > 0)),
        "rev_car_miles_empty": total(miles, revenue & (F.col("content_tons") == 0)),
        "pass_bus_miles": total(miles, code.startswith("M5")),
        "work_car_miles": total(miles, code.between("M100", "M4999")),
        "caboose_miles": total(miles, code == "M930"),
        "sum_hrspwr_qty": total(power),
        "live_loco_hp_miles": total(power * miles, live),
        "dh_loco_hp_miles": total(power * miles, dead),
        "loco_full_weight": total(F.coalesce(heavy, zero)),
        "tare_tons": total(tare),
        "tare_ton_miles": total(tare * miles, car),
        "loco_tare_ton_miles": total(tare * miles, live),
        "dh_tare_ton_miles": total(tare * miles, dead),
        "content_ton_miles": total(content * miles),
        "live_loco_foot_miles": total(amount("loco_inches") / 12 * miles, live),
        "dh_loco_foot_miles": total(amount("loco_inches") / 12 * miles, dead),
        "car_length_feet": total(amount("car_inches")) / 12,
        "loco_foot_miles": total(amount("loco_inches")) / 12,
    }
    return rows.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
