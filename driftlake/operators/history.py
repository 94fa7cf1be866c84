"""Current state and slowly changing history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.operators.cdc import row_hash

OPEN_END = "9999-12-31 23:59:59"


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def current_state(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest of each key's rows in both."""
    return latest(snapshot.unionByName(changes, allowMissingColumns=True), keys, order)


def scd2_history(versions: DataFrame, key: str, attrs: Sequence[str], eff: str, tie: Sequence[str] = (), deleted: Column | None = None, collapse_unchanged: bool = False) -> DataFrame:
    """Number each key's versions and close each a second before the next; the last is current and open.

    All three windows share one shuffle by key."""
    w = Window.partitionBy(key).orderBy(eff, *tie)
    rows = versions.withColumn("attr_hash", row_hash(attrs)).withColumn("is_deleted", deleted if deleted is not None else F.lit(False))
    if collapse_unchanged:
        before = F.lag("attr_hash").over(w)
        rows = rows.withColumn("__b", before).where("__b is null or __b <> attr_hash").drop("__b")
    after = F.lead(eff).over(w)
    end = F.coalesce(after - F.expr("INTERVAL 1 SECOND"), F.lit(OPEN_END).cast(versions.schema[eff].dataType))
    return rows.select(_scd_key(key, eff).alias("scd_key"), key, *attrs, "attr_hash", F.row_number().over(w).alias("version"), F.col(eff).alias("effective_from"), end.alias("effective_to"), after.isNull().alias("is_current"), "is_deleted")


def scd2_snapshot_rows(snapshot: DataFrame, key: str, attrs: Sequence[str], eff: str) -> DataFrame:
    """A snapshot's rows as open versions: surrogate key, attributes and their hash."""
    return _version_rows(snapshot, key, attrs, eff, F.lit(False))


def scd2_change_rows(log: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The same of a change log (<col>_old, <col>_new, op_code, op_last_replicated): new images, old ones of deletes."""
    rows = log_to_current_row(log, [key, *attrs])
    return _version_rows(rows, key, attrs, "op_last_replicated", F.col("is_deleted"))


def _version_rows(rows: DataFrame, key: str, attrs: Sequence[str], eff: str, deleted: Column) -> DataFrame:
    open_end = F.lit(OPEN_END).cast(rows.schema[eff].dataType)
    return rows.select(_scd_key(key, eff).alias("scd_key"), key, *attrs, row_hash(attrs).alias("attr_hash"), F.col(eff).alias("effective_from"), open_end.alias("effective_to"), deleted.alias("is_deleted"))


def _scd_key(key: str, eff: str) -> Column:
    return F.md5(F.concat_ws("~", F.col(key).cast("string"), F.date_format(eff, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def scd2_history_view(history: DataFrame, key: str) -> DataFrame:
    """All versions in order of key and version, sorted by range over all tasks."""
    return history.orderBy(key, "version")


def scd2_current_view(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def scd2_as_of(history: DataFrame, at) -> DataFrame:
    t = F.lit(at).cast(history.schema["effective_from"].dataType)
    return history.where((F.col("effective_from") <= t) & (t <= F.col("effective_to")))


def scd2_close_and_insert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str], as_of: Column) -> DataFrame:
    """Close open rows whose attributes differ and add the new versions; unknown keys start one."""
    inc = incoming.select(*keys, F.struct(*attrs).alias("new"))
    both = current.select(*keys, F.struct(*[c for c in current.columns if c not in keys]).alias("old")).join(inc, list(keys), "full")
    same = F.coalesce(F.struct(*[F.col(f"old.{a}") for a in attrs]).eqNullSafe(F.col("new")), F.lit(False))
    kind = current.schema["effective_from"].dataType
    hit = F.col("old").isNotNull() & F.col("new").isNotNull() & F.col("old.is_current") & ~same
    olds = both.where("old is not null").select(*keys, *[F.col(f"old.{a}").alias(a) for a in attrs], F.col("old.effective_from").alias("effective_from"), F.when(hit, as_of.cast(kind) - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("old.effective_to")).alias("effective_to"), (F.col("old.is_current") & ~hit).alias("is_current"))
    news = both.where(F.col("new").isNotNull() & (F.col("old").isNull() | hit)).select(*keys, *[F.col(f"new.{a}").alias(a) for a in attrs], as_of.cast(kind).alias("effective_from"), F.lit(OPEN_END).cast(kind).alias("effective_to"), F.lit(True).alias("is_current"))
    return olds.unionByName(news)


def log_to_current_row(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """New images, or old ones where there is none, of a log of <col>_old and <col>_new pairs."""
    return log.select(*[F.coalesce(f"{c}_new", f"{c}_old").alias(c) for c in columns], (F.col("op_code") == "D").alias("is_deleted"), "op_last_replicated")


def net_delta_view(base: DataFrame, log: DataFrame, key: str, columns: Sequence[str], rank_by: str) -> DataFrame:
    """Base rows without changes, new images of the latest changes that aren't deletes (ties stay), and all delete rows."""
    values = [key, *columns]
    untouched = base.select(*values).join(log.select(F.col(f"{key}_old").alias("__k")).distinct(), F.col(key).eqNullSafe(F.col("__k")), "left_anti").withColumn("op", F.lit(None).cast("string"))
    w = Window.partitionBy(f"{key}_old").orderBy(F.col(rank_by).desc())
    last = log.withColumn("__r", F.rank().over(w)).where("__r = 1 and op_code <> 'D'")
    news = last.select(*[F.col(f"{c}_new").alias(c) for c in values], F.lit("NULL").alias("op"))
    gone = log.where("op_code = 'D'").select(*[F.col(f"{c}_old").alias(c) for c in values], F.lit("D").alias("op"))
    return untouched.unionByName(news).unionByName(gone)
