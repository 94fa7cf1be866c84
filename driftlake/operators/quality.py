"""Data-quality metrics and the layers of reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.sources.tables import united


def column_metrics(df: DataFrame, column: str, ts: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Null, duplicate and negative counts, and hours since the newest row where ts is given."""
    fresh = [F.timestamp_diff("HOUR", F.max(ts), as_of).alias("freshness_hours")] if ts else []
    c = F.col(column)
    return df.agg(F.count_if(c.isNull()).alias("null_count"), (F.count(c) - F.countDistinct(c)).alias("duplicate_count"), F.count_if(c < 0).alias("negative_count"), *fresh)


def orphan_count(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti").agg(F.count("*").alias("orphan_count"))


def duplicate_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("total_rows"), F.count("*").alias("unique_keys"), (F.sum("n") - F.count("*")).alias("duplicate_rows"))


def quality_score(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The share of checks that hold, and a flag for each that doesn't."""
    held = [F.when(F.coalesce(c, F.lit(False)), F.lit(1.0 / len(checks))).otherwise(0.0) for c in checks.values()]
    return df.withColumns({**{f"missing_{k}": ~F.coalesce(c, F.lit(False)) for k, c in checks.items()}, "quality_score": reduce(Column.__add__, held)})


def field_rules(df: DataFrame, rules: Sequence[tuple[str, Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(name, condition, action) rules: `reject` splits rows off with the failed names, `flag` notes them, `null:<column>`
    clears it. Returns good and rejected rows."""
    def failed(c: Column) -> Column:
        return ~F.coalesce(c, F.lit(False))

    for _, cond, action in rules:
        if action.startswith("null:"):
            name = action.split(":")[1]
            df = df.withColumn(name, F.when(~failed(cond), F.col(name)))
    noted = df.withColumn("flags", F.array_compact(F.array(*[F.when(failed(c), F.lit(n)) for n, c, a in rules if a == "flag"]).cast("array<string>")))
    noted = noted.withColumn("rejects", F.array_compact(F.array(*[F.when(failed(c), F.lit(n)) for n, c, a in rules if a == "reject"]).cast("array<string>")))
    return noted.where(F.size("rejects") == 0).drop("rejects"), noted.where(F.size("rejects") > 0)


def recon_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    spark = a.sparkSession
    left, right = (spark.createDataFrame(list(x.dtypes) or [("", "")], "name string, type string") for x in (a, b))
    both = left.withColumnRenamed("type", "source_type").join(right.withColumnRenamed("type", "target_type"), "name", "full")
    return both.where(~F.col("source_type").eqNullSafe(F.col("target_type")))


def recon_count(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.agg(F.count("*").alias("source_rows")).crossJoin(b.agg(F.count("*").alias("target_rows"))).withColumn("difference", F.col("target_rows") - F.col("source_rows"))


def recon_aggregate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum, least, greatest and number of distinct values of each column, a row for each."""
    each = [f(c).alias(f"{c}__{n}") for c in columns for n, f in (("sum", lambda c: F.sum(F.col(c).cast("decimal(30,2)")).cast("double")), ("min", lambda c: F.min(c).cast("double")), ("max", lambda c: F.max(c).cast("double")), ("distinct", F.countDistinct))]
    wide = df.agg(*each)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{n}").alias(f"{n}_value") for n in ("sum", "min", "max", "distinct")]) for c in columns])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def recon_hash(df: DataFrame) -> DataFrame:
    """A hash of the whole table that no order changes; sums, so that repeated rows don't cancel."""
    return df.agg(F.count("*").alias("n_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("table_hash"))


def row_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (), tolerance: float = 0.0) -> DataFrame:
    """A row for each difference: key, column, both values as text; rows on one side have the column `<row>`."""
    columns = [c for c in a.columns if c not in (*keys, *exclude)]
    numeric = {c for c, t in a.dtypes if t in ("double", "float", "int", "bigint") or t.startswith("decimal")}
    both = a.select(*keys, F.struct(F.lit(1).alias("__"), *columns).alias("s")).join(b.select(*keys, F.struct(F.lit(1).alias("__"), *columns).alias("t")), list(keys), "full")

    def differs(c: str) -> Column:
        apart = ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
        return apart & ~F.coalesce(F.abs(F.col(f"s.{c}") - F.col(f"t.{c}")) <= tolerance, F.lit(False)) if c in numeric and tolerance else apart

    one = F.when(F.col("s").isNull() | F.col("t").isNull(), F.array(F.struct(F.lit("<row>").alias("column_name"), F.when(F.col("s").isNotNull(), "present").alias("source_value"), F.when(F.col("t").isNotNull(), "present").alias("target_value"))))
    cells = F.array_compact(F.array(*[F.when(differs(c), F.struct(F.lit(c).alias("column_name"), F.col(f"s.{c}").cast("string").alias("source_value"), F.col(f"t.{c}").cast("string").alias("target_value"))) for c in columns]))
    return both.select(*keys, F.explode(F.coalesce(one, cells)).alias("d")).select(*keys, "d.*")


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int) -> DataFrame:
    """Count and sums of row hashes of each range of the keys' hash; nulls count, wherever they stand."""
    of = lambda names: F.xxhash64(*[x for c in names for x in (F.col(c), F.col(c).isNull())])
    rows = df.select(F.shiftrightunsigned(of(keys), 64 - bits).alias("bucket"), of([*keys, *columns]).alias("h"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("sums"), F.bit_xor("h").alias("bits"))


#: Bits of the keys' hash in the steps of tree_diff, and ranges that are named in a filter at most.
TREE_BITS, NAMED = (10, 20), 1 << 14


def tree_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (), tolerance: float = 0.0) -> DataFrame:
    """row_diff of tables that hardly differ: only rows of differing ranges of the keys' hash meet.

    Each side gives one digest a range, 1,024 of them, then 1,024 to each range whose digests differ. Equal tables move nothing
    but digests; where very many ranges differ, the rows of the coarser ones meet."""
    columns = [c for c in a.columns if c not in (*keys, *exclude)]
    types = dict(a.dtypes)
    b = b.select(*[F.col(c).cast(types[c]) if types[c] != t else F.col(c) for c, t in b.dtypes if c in (*keys, *columns)])
    a = a.select(*keys, *columns)
    for bits in TREE_BITS:
        left, right = (_digests(x, keys, columns, bits) for x in (a, b))
        apart = left.alias("l").join(right.alias("r"), "bucket", "full").where("not (l.n <=> r.n and l.sums <=> r.sums and l.bits <=> r.bits)")
        some = [r["bucket"] for r in apart.select("bucket").limit(NAMED + 1).collect()]
        if len(some) > NAMED:
            break
        keyed = F.shiftrightunsigned(F.xxhash64(*[x for c in keys for x in (F.col(c), F.col(c).isNull())]), 64 - bits)
        a, b = (x.where(keyed.isin(some) if some else F.lit(False)) for x in (a, b))
        if not some:
            break
    return row_diff(a, b, keys, (), tolerance)


def recon_hash_text(df: DataFrame, columns: Sequence[str], sep: str = "|") -> DataFrame:
    """The same of a canonical text of the columns, so that other engines can count it too: 56 bits of each row's MD5, summed."""
    row = F.md5(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]))
    bits = F.conv(F.left(row, F.lit(14)), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(bits).cast("string").alias("table_hash"))


def recon_rules(rules: dict[str, str], **tables: DataFrame) -> DataFrame:
    """Users' SQL, each of whose rows breaks its rule, over named tables ({name}): violations of each rule, and whether there are none."""
    spark = SparkSession.active()

    def one(name: str, sql: str) -> DataFrame:
        used = {t: df for t, df in tables.items() if f"{{{t}}}" in sql}
        return spark.sql(sql, **used).agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations", (F.col("violations") == 0).alias("passed"))

    return united([one(n, s) for n, s in rules.items()], "rule string, violations long, passed boolean")


def recon_counts_union(tables: dict[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Rows of each table's source, stream and target, from one aggregation over the three together."""
    sides = ("source_rows", "stream_rows", "target_rows")

    def one(name: str, dfs: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.union, [df.select(F.lit(s).alias("side")) for s, df in zip(sides, dfs, strict=True)])
        return rows.agg(*[F.count_if(F.col("side") == s).alias(s) for s in sides]).select(F.lit(name).alias("table_name"), *sides)

    return united([one(n, d) for n, d in tables.items()], "table_name string, source_rows long, stream_rows long, target_rows long")


def pipeline_health(tables: dict[str, tuple[DataFrame, str, str, str]], now: Column) -> DataFrame:
    """Rows, keys, null keys, negative amounts and minutes since the newest row of each table (df, key, amount, time)."""

    def one(name: str, df: DataFrame, key: str, amount: str, ts: str) -> DataFrame:
        since = F.timestamp_diff("MINUTE", F.date_trunc("minute", F.max(ts)), F.date_trunc("minute", now))
        return df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("keys"), F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.col(amount) < 0).alias("negatives"), since.alias("minutes_since_refresh")).select(F.lit(name).alias("t"), "*")

    return united([one(n, *t) for n, t in tables.items()], "t string, n long, keys long, null_keys long, negatives long, minutes_since_refresh long")


def standardize(df: DataFrame, loaded: Column, system: str) -> DataFrame:
    """Every text column trimmed, with the time of the load and the system that it came from."""
    texts = {c: F.trim(c) for c, t in df.dtypes if t == "string"}
    return df.withColumns({**texts, "load_ts": loaded, "source_system": F.lit(system)})


def validate_log(checks: dict[str, DataFrame], at: Column) -> DataFrame:
    """Rows of the validation log: the count of each check's findings, its status and time; for appending with the table's writer."""
    rows = [df.agg(F.count("*").alias("n_issues")).select(F.lit(n).alias("issue"), "n_issues", F.when(F.col("n_issues") > 0, "FAILED").otherwise("PASSED").alias("status"), at.alias("checked_at")) for n, df in checks.items()]
    return united(rows, "issue string, n_issues long, status string, checked_at timestamp_ntz")


def referential(child: DataFrame, parent: DataFrame, key: str, parent_key: str, dates: Sequence[str] = (), dummy: int = -1, default_date: str = "1900-01-01") -> DataFrame:
    """Rows of child with the dummy key where the parent is missing, and a default for dates that are missing."""
    known = parent.select(F.col(parent_key).alias("__p")).distinct()
    rows = child.join(known, F.col(key) == F.col("__p"), "left").withColumn(key, F.coalesce("__p", F.lit(dummy))).drop("__p")
    return rows.withColumns({d: F.coalesce(d, F.lit(default_date).cast(child.schema[d].dataType)) for d in dates})


def record_metrics(df: DataFrame, measures: dict[str, tuple[Column, float]]) -> DataFrame:
    """Each measure's percentage (a share of rows, or of distinct values, in 0 to 1) and whether it reaches its threshold."""
    wide = df.agg(*[F.round(100.0 * share, 2).alias(n) for n, (share, _) in measures.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("pct"), F.lit(float(least)).alias("threshold"), (F.col(n) >= least).alias("passed")) for n, (_, least) in measures.items()])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def source_target_match(source: DataFrame, target: DataFrame, source_ts: str, target_ts: str) -> DataFrame:
    """How much of the source the target has, HEALTHY from 99 %, WARNING from 95 %, and how many minutes it lags behind."""
    both = source.agg(F.count("*").alias("source_rows"), F.max(source_ts).alias("s")).crossJoin(target.agg(F.count("*").alias("target_rows"), F.max(target_ts).alias("t")))
    pct = F.when(F.col("source_rows") > 0, F.round(100.0 * F.col("target_rows") / F.col("source_rows"), 2)).otherwise(100.0)
    lag = F.timestamp_diff("MINUTE", F.date_trunc("minute", "t"), F.date_trunc("minute", "s"))
    rows = both.select("source_rows", "target_rows", pct.alias("pct"), lag.alias("lag_minutes"))
    return rows.withColumn("status", F.when(F.col("pct") >= 99, "HEALTHY").when(F.col("pct") >= 95, "WARNING").otherwise("CRITICAL"))
