"""Change streams: the batch functions, applied to micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlake.operators.cdc import initial_snapshot
from driftlake.operators.history import latest
from driftlake.sources.versioned import VersionedTable


def absorb(table: VersionedTable, name: str, as_of: Column | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: add each batch to the table, once, however often it is repeated; then tend the table's files."""

    def apply(batch: DataFrame, n: int) -> None:
        if table.manifest()["applied"].get(name, -1) < n:
            table.append(batch, as_of, f"BATCH_{n}", {name: n})
            table.tend()

    return apply


def stream_cdc_apply(changes: DataFrame, table: VersionedTable, checkpoint: str, trigger: dict | None = None, as_of: Column | None = None, name: str = "cdc") -> StreamingQuery:
    """Merge every micro-batch of changes (the table's columns and order, cdc_action, cdc_is_update, row_id) into the table.

    The table ends as a replay in its order would leave it, also where a key has several changes in a batch, changes come a batch
    late or twice; a batch that is repeated after a failure changes nothing more."""
    return changes.writeStream.foreachBatch(absorb(table, name, as_of)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_incremental_current(changes: DataFrame, table: VersionedTable, checkpoint: str, trigger: dict | None = None, name: str = "current") -> StreamingQuery:
    """Keep each key's newest row, by the table's order."""
    return changes.writeStream.foreachBatch(absorb(table, name)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_append_only(changes: DataFrame, to: str, checkpoint: str) -> StreamingQuery:
    """Append plain inserts, and nothing else, to a Parquet table."""
    plain = changes.where("cdc_action = 'INSERT' and not cdc_is_update")
    return plain.writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_has_data_gate(changes: DataFrame, checkpoint: str, action: Callable[[DataFrame, int], None]) -> bool:
    """Run action on what has come since the last call, if anything has; whether it ran."""
    ran = []

    def gate(batch: DataFrame, n: int) -> None:
        if not batch.isEmpty():
            action(batch, n)
            ran.append(n)

    changes.writeStream.foreachBatch(gate).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return bool(ran)


def stream_offset_recovery(spark: SparkSession, changes: DataFrame, base: DataFrame, table: VersionedTable, checkpoint: str, as_of: Column, name: str = "cdc") -> tuple[str, StreamingQuery]:
    """Go on with a stream whose checkpoint may be lost: then the base is reloaded first, and a stream of a new name starts anew.

    Status RECOVERY (reloaded) or SUCCESS; what the new stream reads again changes only what the table's order lets it. The base is
    the source's state: where the table has an order, its columns tell which changes it has seen already."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    applied = table.manifest()["applied"]
    if there or name not in applied:
        return "SUCCESS", stream_cdc_apply(changes, table, checkpoint, None, as_of, name)
    # a key's reloaded rows would all have the same row_id, which thus orders nothing and isn't stored
    table.append(initial_snapshot(base, table.keys).withColumn("row_id", F.lit("")), as_of, f"RECOVERY_{name}", {name: -1}, reload=True)
    return "RECOVERY", stream_cdc_apply(changes, table, checkpoint, None, as_of, name)


def late_rows(rows: DataFrame, event_ts: str, load_ts: str, start: Column, end: Column, days: int, keys: Sequence[str]) -> DataFrame:
    """Rows loaded in a window, with those of up to `days` days before it that came late, each key once (the last loaded)."""
    back = F.col(event_ts) >= start - F.make_dt_interval(F.lit(days))
    window = rows.where((F.col(load_ts) >= start) & (F.col(load_ts) < end) & back)
    return latest(window, keys, [F.desc(load_ts)]).withColumn("is_late", F.col(event_ts) < start)
