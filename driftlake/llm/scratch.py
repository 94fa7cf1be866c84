"""Shared scratch tables and bounded bitmaps."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftlake.llm.words import tidy, xxhash64

#: Bits of a filter: eight for each key, at least 2**LEAST_BITS and at most 2**MOST_BITS (32 MB, 3 * 10**7 keys; a fuller one
#: lets more rows through to the exact step behind it, and loses none).
LEAST_BITS, MOST_BITS = 20, 28
#: Bytes of rows that go to Python at once: a batch stands in the JVM and in Python, and long texts make large ones.
BATCH_BYTES, _BATCH = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once for a SparkContext, and bound the session's Arrow batches."""
    sc = spark.sparkContext
    most = spark.conf.get(_BATCH)
    if most.endswith("b") and most[:-1].isdigit() and int(most[:-1]) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
    if getattr(sc, "_driftlake_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="spark-")) / "driftlake.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))
    sc._driftlake_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set and Spark is a single local process."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and (kept := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        at = kept.get()
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(at)
    return at


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/driftlake-{spark.sparkContext.applicationId}"


def write_shared(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder and read it back (as schema, if one is given); clear_shared()
    removes it."""
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Remove the tables that this application has written with write_shared; results that read them must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bitmap(df: DataFrame, key: Column) -> np.ndarray:
    """A Bloom filter of the values of key, a well mixed long: four bits each. Only its words reach the driver, 2**22 at most."""
    keys = write_shared(df.select(key.alias("a")), "keys")
    size = min(MOST_BITS, max(LEAST_BITS, (8 * keys.count()).bit_length()))
    mask, low = (1 << size) - 1, 64 - size
    places = ", ".join(f"shiftrightunsigned({x}, {low}), shiftrightunsigned({x}, 12) & {mask}L" for x in "ab")
    rows = keys.withColumn("b", F.xxhash64("a")).selectExpr(f"explode(array({places})) AS at").selectExpr("at >> 6 AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit").groupBy("word")
    rows = rows.agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    del rows
    tidy()
    return bits


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each uint64 key may be among those of the filter."""
    size = len(bits).bit_length() + 5
    mask, low = np.uint64((1 << size) - 1), np.uint64(64 - size)

    def has(at: np.ndarray) -> np.ndarray:
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    found = has(keys >> low)
    left = np.flatnonzero(found)
    some = keys[left]
    other = xxhash64(some)
    found[left] = has(some >> np.uint64(12) & mask) & has(other >> low) & has(other >> np.uint64(12) & mask)
    return found


def may_be_among(ids: DataFrame, id_col: Column) -> Column:
    """Whether id_col may be one of ids (one column of longs): true of all that are, and of few others; false for null.

    Only the ids go to Python, so that texts beside them stay where they are."""
    spark = ids.sparkSession
    ship(spark)
    bits = spark.sparkContext.broadcast(bitmap(ids.toDF("id"), F.xxhash64("id")))

    @F.arrow_udf("boolean")
    def among(column: pa.Array) -> pa.Array:
        known = column.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(in_bitmap(bits.value, xxhash64(column.fill_null(0).to_numpy(zero_copy_only=False))) & known)

    return among(id_col.cast("long"))


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id isn't in gone (one column of longs); rows of null id stay.

    Only rows whose id may be in gone, by a Bloom filter, take part in the anti-join and its shuffle."""
    gone = write_shared(gone.toDF(id_col).distinct(), "gone")
    marked = docs.withColumn("__may", may_be_among(gone, F.col(id_col)))
    may = marked.where("__may").drop("__may").join(gone, id_col, "left_anti").select(*docs.columns)
    return marked.where("not __may").drop("__may").unionByName(may)
