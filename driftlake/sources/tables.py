"""Readers, writers and versioned tables over Parquet."""

from __future__ import annotations

import csv
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for written tables: below the cluster's shared one (spark.checkpoint.dir), or a local one in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{at}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df worked out once, into a table of its own, which later steps read."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _landed(lines: DataFrame) -> DataFrame:
    data = F.try_parse_json("value")
    return lines.withColumn("data", data).where(F.col("data").isNotNull() | (F.trim("value") == "null")).drop("value")


def load_json_landing(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON as variants (data), with file_name and row_number (from 1 in each file); lines that don't parse are left out.

    A line's number is its place in its block of the file and the lines of the blocks before, so that a large file is read by
    many tasks: only counts of blocks meet in one."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    per = raw.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = raw.withColumn("at", F.row_number().over(Window.partitionBy("file", "block").orderBy("id"))).join(per.select("file", "block", before.alias("before")), ["file", "block"])
    return _landed(numbered.select("value", "file_name", (F.col("before") + F.col("at")).alias("row_number"))).select("data", "file_name", "row_number")


def load_json_continuous(spark: SparkSession, path: str, to: str, checkpoint: str) -> StreamingQuery:
    """Append the lines of files that have come since the last call to the table at `to`; started, and ends by itself."""
    lines = spark.readStream.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    out = _landed(lines).select(F.to_json("data").alias("data"), "file_name")
    return out.writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scan_log_append_only(log: DataFrame, offset_col: str, after) -> tuple[DataFrame, DataFrame]:
    """Rows appended to a log since an offset, and the offset to go on from (one row; the old one where nothing came)."""
    new = log.where(F.col(offset_col) > F.lit(after))
    return new, new.agg(F.coalesce(F.max(offset_col), F.lit(after).cast(log.schema[offset_col].dataType)).alias("offset"))


def scan_change_stream(changes: DataFrame, path: str) -> DataFrame:
    """A change batch (columns, cdc_action, cdc_is_update, row_id) read once into a staged copy, which later steps read."""
    changes.write.parquet(path)
    return changes.sparkSession.read.schema(changes.schema).parquet(path)


def clean_names(names: list[str]) -> list[str]:
    """Lower-case identifiers; a repeated one gets a number."""
    out: list[str] = []
    for n in names:
        base = re.sub(r"\W+", "_", n.strip().lower()).strip("_") or "column"
        k, i = base, 1
        while k in out:
            i += 1
            k = f"{base}_{i}"
        out.append(k)
    return out


def delimited_layouts(spark: SparkSession, pattern: str, sep: str = ",") -> list[tuple[list[str], list[str]]]:
    """The files of a pattern by their header, in order of the files: clean and unique column names, and the files that have them.

    Only each file's first line is read; files without one have no layout."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    found: dict[tuple[str, ...], list[str]] = {}
    some = list(fs.globStatus(path) or [])
    if not some:
        raise FileNotFoundError(pattern)
    for s in sorted(some, key=lambda s: s.getPath().toString()):
        if s.isDirectory() or s.getPath().getName()[:1] in "._":
            continue
        reader = sc._jvm.java.io.BufferedReader(sc._jvm.java.io.InputStreamReader(fs.open(s.getPath()), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            header = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep))
            found.setdefault(tuple(clean_names(header)), []).append(s.getPath().toString())
    return [(list(names), files) for names, files in found.items()]


def load_delimited_batch(spark: SparkSession, pattern: str, sep: str = ",", layouts: list | None = None) -> DataFrame:
    """Delimited files with a header each, as text, with clean and unique column names.

    Files of one header are read together by its names, and the groups are united by name: columns may stand in any order, and those that
    a file doesn't have are null. Columns stand as the files first have them."""
    parts = []
    for names, files in delimited_layouts(spark, pattern, sep) if layouts is None else layouts:
        schema = StructType([StructField(n, StringType()) for n in names])
        parts.append(spark.read.schema(schema).option("header", True).option("sep", sep).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else spark.createDataFrame([], "nothing string").drop("nothing")


def load_delimited(spark: SparkSession, patterns: dict[str, str], to: str, mode: str = "overwrite", sep: str = ",") -> DataFrame:
    """Load the files of each pattern into the table `to`/name; the load log: table_name, n_rows, n_columns, status and message, which
    tells which columns some of the files lack.

    One load that fails, say for files that aren't there, doesn't stop the others."""
    rows = []
    for name, pattern in patterns.items():
        try:
            layouts = delimited_layouts(spark, pattern, sep)
            df = load_delimited_batch(spark, pattern, sep, layouts)
            write_table(df, f"{to}/{name}", mode)
            written = spark.read.schema(df.schema).parquet(f"{to}/{name}")
            lacking = {c: sum(len(files) for names, files in layouts if c not in names) for c in df.columns}
            told = ", ".join(f"{c} missing in {n} file{'s' * (n > 1)}" for c, n in lacking.items() if n)
            rows.append((name, written.count(), len(df.columns), "SUCCESS", told or None))
        except Exception as e:  # noqa: BLE001
            rows.append((name, 0, 0, "FAILED", type(e).__name__))
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_columns int, status string, message string")


def united(parts: list[DataFrame], schema: str) -> DataFrame:
    """The parts' rows; without parts none, of the schema."""
    return reduce(DataFrame.unionByName, parts) if parts else SparkSession.active().createDataFrame([], schema)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """mode: overwrite, append, or error where the table is there."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def snapshot_copy(df: DataFrame, path: str, stamp: str) -> str:
    """A dated full copy; an older one of the same date isn't overwritten."""
    df.write.mode("error").parquet(f"{path}/snapshot={stamp}")
    return f"{path}/snapshot={stamp}"


def synth_rows(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("record_id"), F.concat(F.lit("K"), F.lpad(F.col("id").cast("string"), 10, "0")).alias("record_key"), (F.rand(seed) * 1000).cast("decimal(18,4)").alias("number_col_1"), F.md5(F.col("id").cast("string")).alias("string_col_1"))
