"""Change data capture: deduplicate and coalesce changes, merge them with soft deletes, recover after a lost offset."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The columns that every target has beside those of its source.
CDC_COLUMNS = ("cdc_operation", "cdc_timestamp", "is_deleted", "record_created_at", "record_updated_at", "source_load_batch_id")
#: Those that a change batch has.
CHANGE_COLUMNS = ("cdc_action", "cdc_is_update", "row_id")


def initial_snapshot(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A first read: every row as a plain insert."""
    return base.withColumns({"cdc_action": F.lit("INSERT"), "cdc_is_update": F.lit(False), "row_id": F.md5(F.concat_ws("~", *keys))})


def null_key_filter(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def purge_filter(df: DataFrame, owner: str, purged: Sequence[str]) -> DataFrame:
    """Drop rows of purged owners; rows without an owner stay."""
    return df.where(~F.coalesce(F.col(owner), F.lit("")).isin(*purged))


def stage_validation(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch, or an error when a key part is null: a filter that raises, so that every job over the batch tests it, whichever
    columns it needs, without a pass of its own."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return batch.where(F.when(has_null, F.raise_error(F.lit("null in a key of the batch")).cast("boolean")).otherwise(True))


def cdc_dedup(batch: DataFrame, keys: Sequence[str], order: Sequence[Column], mode: str = "latest") -> DataFrame:
    """One row for each key (`latest`; `insert_priority`: inserts before deletes) or for each key and kind of change (`by_action`)."""
    by = [*keys, "cdc_action", "cdc_is_update"] if mode == "by_action" else list(keys)
    first = [F.when(F.col("cdc_action") == "INSERT", 0).otherwise(1)] if mode == "insert_priority" else []
    w = Window.partitionBy(*by).orderBy(*first, *order)
    return batch.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def cdc_coalesce(log: DataFrame, keys: Sequence[str], seq: Sequence[str], op: str) -> DataFrame:
    """The net change of each key from its ordered I, U and D changes, with the last values; insert..delete is nothing."""
    order = F.struct(*seq)
    rest = [c for c in log.columns if c not in (*keys, op)]
    net = log.groupBy(*keys).agg(F.min_by(op, order).alias("first_op"), F.max_by(op, order).alias("last_op"), F.max_by(F.struct(*rest), order).alias("row"))
    action = F.when(F.col("last_op") == "D", F.when(F.col("first_op") != "I", "DELETE")).otherwise("INSERT")
    net = net.withColumn("cdc_action", action).where("cdc_action is not null")
    return net.select(*keys, *[F.col("row")[c].alias(c) for c in rest], "cdc_action", ((F.col("cdc_action") == "INSERT") & (F.col("first_op") != "I")).alias("cdc_is_update"))


def cdc_pre_metrics(batch: DataFrame) -> DataFrame:
    insert = F.col("cdc_action") == "INSERT"
    return batch.agg(F.count_if(insert & ~F.col("cdc_is_update")).alias("n_insert"), F.count_if(insert & F.col("cdc_is_update")).alias("n_update"), F.count_if((F.col("cdc_action") == "DELETE") & ~F.col("cdc_is_update")).alias("n_delete"))


def cdc_duplicate_detect(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    plain = batch.where("cdc_action = 'INSERT' and not cdc_is_update").select(*keys).distinct()
    return plain.join(target.select(*keys), list(keys), "left_semi").agg(F.count("*").alias("n_duplicates"))


def new_target(base: DataFrame, as_of: Column, batch_id: str) -> DataFrame:
    return base.withColumns({"cdc_operation": F.lit("INSERT"), "cdc_timestamp": as_of, "is_deleted": F.lit(False), "record_created_at": as_of, "record_updated_at": as_of, "source_load_batch_id": F.lit(batch_id)})


def cdc_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], as_of: Column, batch_id: str, insert_label: str = "INSERT", ordered_by: Sequence[Column] = (), reload: bool = False, fixed: Sequence[str] = ()) -> DataFrame:
    """The target after the batch, in one full outer join on the keys.

    Inserts overwrite or add rows and undo deletes; deletes only mark; old images of updates and deletes of unknown keys do
    nothing; rows of null keys are ignored; creation times stay. reload: the recovery form, which labels what it
    overwrites RELOADED. fixed: columns that no change sets. A key's changes are reduced to one first (inserts before deletes, then ordered_by, then row_id)."""
    values = [c for c in target.columns if c not in (*keys, *CDC_COLUMNS)]
    live = null_key_filter(batch, keys).where(~((F.col("cdc_action") == "DELETE") & F.col("cdc_is_update")))
    live = cdc_dedup(live, keys, [*ordered_by, F.col("row_id").desc()], "insert_priority")
    s = live.select(*keys, F.struct(*[c for c in values if c not in fixed], "cdc_action", "cdc_is_update").alias("s"))
    t = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("t"))
    both = t.join(s, list(keys), "full").where("t is not null or s.cdc_action = 'INSERT'")
    put, cut, old = F.col("s.cdc_action") == "INSERT", F.col("s.cdc_action") == "DELETE", F.col("t").isNotNull()
    put = F.coalesce(put, F.lit(False))
    cut = F.coalesce(cut, F.lit(False))
    label = F.lit("RELOADED") if reload else F.when(F.col("s.cdc_is_update"), "UPDATE").otherwise(insert_label)
    operation = F.when(put & old, label).when(put, "INSERT").when(cut, "DELETE").otherwise(F.col("t.cdc_operation"))
    changed = put | cut
    types = dict(target.dtypes)
    now = lambda c: as_of.cast(types[c])
    return both.select(
        *keys,
        *[F.col(f"t.{c}") if c in fixed else F.when(put, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in values],
        operation.alias("cdc_operation"),
        F.when(changed, now("cdc_timestamp")).otherwise(F.col("t.cdc_timestamp")).alias("cdc_timestamp"),
        F.when(put, False).when(cut, True).otherwise(F.col("t.is_deleted")).alias("is_deleted"),
        F.when(old, F.col("t.record_created_at")).otherwise(now("record_created_at")).alias("record_created_at"),
        F.when(changed, now("record_updated_at")).otherwise(F.col("t.record_updated_at")).alias("record_updated_at"),
        F.when(changed, F.lit(batch_id)).otherwise(F.col("t.source_load_batch_id")).alias("source_load_batch_id"),
    ).select(*target.columns)


def cdc_recovery_merge(target: DataFrame, base: DataFrame, keys: Sequence[str], as_of: Column, batch_id: str, differential: bool = False) -> DataFrame:
    """Reload the whole base (or only rows missing from the target or deleted in it) after a lost offset."""
    batch = initial_snapshot(base, keys)
    if differential:
        batch = batch.join(target.where("not is_deleted").select(*keys), list(keys), "left_anti")
    return cdc_merge(target, batch, keys, as_of, batch_id, reload=True)


def detect_soft_deletes(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.where("not is_deleted").select(*keys).join(source.select(*keys), list(keys), "left_anti")


def watermark_incremental(source: DataFrame, ts: str, watermark) -> DataFrame:
    return source.where(F.col(ts) > F.lit(watermark))


def watermark_advance(source: DataFrame, ts: str, watermarks: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows after the table's stored watermark (table_name, watermark), and the watermarks with the table's moved to their newest.

    The watermark is read before the rows are planned, so that their scan skips what is before it. A table without a watermark is
    read whole; no new rows leave it where it is."""
    kind = watermarks.schema["watermark"].dataType
    mark = watermarks.where(F.col("table_name") == table).agg(F.max("watermark").cast("string").alias("w")).first()["w"]
    known = F.lit(mark).cast(kind)
    rows = source if mark is None else source.where(F.col(ts) > known)
    newest = rows.agg(F.max(ts).alias("n")).select(F.lit(table).alias("table_name"), F.coalesce(F.col("n"), known).cast(kind).alias("watermark"))
    return rows, watermarks.where(F.col("table_name") != table).unionByName(newest)


def exact_hash(columns: Sequence[str]) -> Column:
    """A hash that tells nulls from empty texts, and where a text ends: every value has its length before it."""
    text = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.md5(F.concat(*map(text, columns)))


def row_hash(columns: Sequence[str], sep: str = "~") -> Column:
    return F.md5(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def hash_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Source rows that are new or whose hash differs from the target's."""
    known = target.select(*keys, row_hash(columns).alias("__hash"))
    return source.withColumn("__hash", row_hash(columns)).join(known, [*keys, "__hash"], "left_anti").drop("__hash")


def merge_hash_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], of: Callable[[Sequence[str]], Column] = exact_hash) -> DataFrame:
    """The target with the source's rows that are new or whose hash over columns differs; the others stay as they were.

    of: exact_hash, or row_hash where hashes must be those of a log (it takes null for '', and 'a~', 'b' for 'a', '~b')."""
    s = source.select(*keys, of(columns).alias("__hash"), F.struct(*target.columns).alias("s"))
    t = target.withColumn("__own", of(columns)).select(*keys, "__own", F.struct(*target.columns).alias("t"))
    put = F.col("s").isNotNull() & ~F.col("__hash").eqNullSafe(F.col("__own"))
    return t.join(s, list(keys), "full").select(F.when(put, F.col("s")).otherwise(F.col("t")).alias("r")).select("r.*")


def config_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of source (of a key that it repeats the greatest row), and those of target whose key source doesn't have."""
    rest = [c for c in source.columns if c not in keys]
    once = source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("r")).select(*keys, "r.*").select(*source.columns)
    return once.unionByName(target.join(source.select(*keys), list(keys), "left_anti"))


def cdc_merge_staged(target: DataFrame, log: DataFrame, keys: Sequence[str], seq: Sequence[str], op: str, as_of: Column, batch_id: str) -> DataFrame:
    """Fold an ordered log of I, U and D into one net change for each key first, then merge: deleted, or not."""
    net = cdc_coalesce(log, keys, seq, op)
    values = [c for c in target.columns if c not in (*keys, *CDC_COLUMNS)]
    staged = net.select(*keys, *values, "cdc_action", "cdc_is_update", F.md5(F.concat_ws("~", *keys)).alias("row_id"))
    return cdc_merge(target, staged, keys, as_of, batch_id)


def cdc_generic(target: DataFrame, batch: DataFrame, config: dict, as_of: Column, batch_id: str) -> DataFrame:
    """The merge as a config says: keys; columns (all others that the target has); filter, a condition on the batch; purge_owner
    and purged, rows of which are left out; validate, to fail on null keys; insert_label. Columns of the target that the config
    doesn't name stay as they were (null in new rows)."""
    keys = config["keys"]
    columns = config.get("columns") or [c for c in target.columns if c not in (*keys, *CDC_COLUMNS)]
    if config.get("filter"):
        batch = batch.where(config["filter"])
    if config.get("purge_owner"):
        batch = purge_filter(batch, config["purge_owner"], config["purged"])
    if config.get("validate"):
        batch = stage_validation(batch, keys)
    other = [c for c in target.columns if c not in (*keys, *columns, *CDC_COLUMNS)]
    return cdc_merge(target, batch.select(*keys, *columns, *CHANGE_COLUMNS), keys, as_of, batch_id, config.get("insert_label", "INSERT"), fixed=other)


def _as_changes(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows as changes that overwrite or add."""
    return initial_snapshot(source, keys).withColumn("cdc_is_update", F.lit(True))


def cdc_sync(target: DataFrame, source: DataFrame, keys: Sequence[str], as_of: Column, batch_id: str, mode: str = "FULL", ts: str | None = None, watermark=None) -> DataFrame:
    """Bring the target up to its source: FULL merges every row; INCREMENTAL those whose ts is after the watermark; SOFT_DELETE
    every row, and marks keys that the source has no more."""
    if mode == "INCREMENTAL":
        return cdc_merge(target, _as_changes(watermark_incremental(source, ts, watermark), keys), keys, as_of, batch_id)
    batch = _as_changes(source, keys)
    if mode == "SOFT_DELETE":
        gone = detect_soft_deletes(target, source, keys)
        gone = gone.withColumns({"cdc_action": F.lit("DELETE"), "cdc_is_update": F.lit(False), "row_id": F.md5(F.concat_ws("~", *keys))})
        batch = batch.unionByName(gone, allowMissingColumns=True)
    elif mode != "FULL":
        raise ValueError(f"no mode {mode}")
    return cdc_merge(target, batch, keys, as_of, batch_id)


def cdc_process_all(configs: Sequence[dict], run: Callable[[dict], DataFrame], write: Callable[[dict, DataFrame], object]) -> list[dict]:
    """Run and write every active config in order of priority; one that fails, while it is planned or while it runs, doesn't stop
    the others. What write returns is the status's result."""
    out = []
    for c in sorted((c for c in configs if c.get("active", True)), key=lambda c: c.get("priority", 100)):
        try:
            out.append({"table": c["table"], "status": "SUCCESS", "result": write(c, run(c)), "message": None})
        except Exception as e:  # noqa: BLE001
            out.append({"table": c["table"], "status": "ERROR", "result": None, "message": str(e)[:500]})
    return out


def cdc_filtered_run(configs: Sequence[dict], run: Callable[[dict], DataFrame], write: Callable[[dict, DataFrame], object], pattern: str = "*", dry_run: bool = False) -> list[dict]:
    """cdc_process_all over the configs whose table matches the pattern; dry_run: which those are, without running any."""
    some = [c for c in configs if fnmatch.fnmatchcase(c["table"], pattern)]
    if dry_run:
        return [{"table": c["table"], "status": "DRY_RUN", "result": None, "message": None} for c in some if c.get("active", True)]
    return cdc_process_all(some, run, write)
