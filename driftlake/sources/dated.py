"""Tables in a folder a day: reads that skip closed days, writes of some days alone, and deletion of old ones by their folders."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "on_day"


class DatedTable:
    """Rows in folders by the day of ts_col; rows of a null time have a folder of their own.

    A write replaces whole days, each at once, and leaves the files of other days as they are."""

    def __init__(self, spark: SparkSession, path: str, ts_col: str):
        self.spark, self.path, self.ts_col = spark, path, ts_col
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def days(self) -> list[datetime.date]:
        """Days that have a folder (the one of null times aside)."""
        if not self._fs.exists(self._at("")):
            return []
        names = [s.getPath().getName().partition("=")[2] for s in self._fs.listStatus(self._at("")) if s.isDirectory()]
        return sorted(datetime.date.fromisoformat(n) for n in names if n[:1].isdigit())

    def _dealt(self, df: DataFrame) -> DataFrame:
        """A day's rows together, but in several files where it has very many."""
        return df.withColumn(DAY, F.to_date(self.ts_col)).hint("rebalance", DAY)

    def replace(self, df: DataFrame) -> None:
        """Write the days of df's rows, in place of what these days had."""
        self._dealt(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self.path)

    def aside(self) -> DatedTable:
        """A new table in a hidden folder of this one, from which days can be taken."""
        return DatedTable(self.spark, f"{self.path}/_aside-{uuid.uuid4().hex}", self.ts_col)

    def take(self, aside: DatedTable, days: Sequence[datetime.date]) -> None:
        """Put the folders of days of a table aside in the place of one's own; days that it hasn't go. It is removed then."""
        there = set(aside.days())
        for d in days:
            name = f"{DAY}={d.isoformat()}"
            self._fs.delete(self._at(name), True)
            if d in there and not self._fs.rename(aside._at(name), self._at(name)):
                raise OSError(f"{aside.path}/{name} can't be put in its place")
        self._fs.delete(aside._at(""), True)

    def refresh(self, df: DataFrame, days: Sequence[datetime.date]) -> None:
        """Make df's rows all that these days have. df, which may read them, is written once, aside, before they go."""
        aside = self.aside()
        aside.add(df.where(F.to_date(self.ts_col).isin(list(days)) if days else F.lit(False)))
        self.take(aside, days)

    def add(self, df: DataFrame) -> None:
        self._dealt(df).write.mode("append").partitionBy(DAY).parquet(self.path)

    def read(self, schema: StructType | None = None, first: datetime.date | None = None, last: datetime.date | None = None, days: Sequence[datetime.date] | None = None) -> DataFrame:
        """Rows of the days from first to last, or of some days: other days' folders are not read. Without bounds all rows, with those
        of null times. schema: of the rows, for a table that may be empty."""
        if schema is not None and not self._fs.exists(self._at("")):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.parquet(self.path) if schema is None else self.spark.read.schema(StructType([*schema.fields]).add(DAY, "date")).parquet(self.path)
        if first is not None:
            rows = rows.where(F.col(DAY) >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col(DAY) <= F.lit(last))
        if days is not None:
            rows = rows.where(F.col(DAY).isin(list(days)) if days else F.lit(False))
        return rows.drop(DAY)

    def open_split(self, closed_before: datetime.date) -> tuple[DataFrame, DataFrame]:
        """The rows of days that are still open (and those of null times), and of the closed ones, each without the others' files."""
        rows = self.spark.read.parquet(self.path)
        open_ = F.col(DAY).isNull() | (F.col(DAY) >= F.lit(closed_before))
        return rows.where(open_).drop(DAY), rows.where(F.col(DAY) < F.lit(closed_before)).drop(DAY)

    def drop(self, days: Sequence[datetime.date]) -> None:
        for d in days:
            self._fs.delete(self._at(f"{DAY}={d.isoformat()}"), True)

    def delete_before(self, limit: datetime.datetime) -> dict:
        """Delete rows older than limit; rows of null times stay. Days that end before it go by their folder, the day that it parts is
        written again, later ones stay untouched. The log: rows_before, rows_deleted, rows_after, days_dropped, days_rewritten.

        It can be repeated at any time: what is gone already isn't counted, and a run that broke off is completed."""
        border = limit.date()
        old = [d for d in self.days() if d < border]
        if not self.days() and not self._fs.exists(self._at("")):
            return {"rows_before": 0, "rows_deleted": 0, "rows_after": 0, "days_dropped": 0, "days_rewritten": 0}
        rows = self.spark.read.parquet(self.path)
        gone = F.coalesce(F.col(self.ts_col) < F.lit(limit).cast(rows.schema[self.ts_col].dataType), F.lit(False))
        part = rows.where(F.col(DAY) == F.lit(border))
        n = rows.agg(F.count("*").alias("all"), F.count_if(F.col(DAY) < F.lit(border)).alias("old")).first()
        in_border = part.agg(F.count_if(gone).alias("gone"), F.count_if(~gone).alias("kept")).first()
        if in_border["gone"]:
            if in_border["kept"]:
                self.replace(part.where(~gone).drop(DAY))
            else:
                old.append(border)
        self.drop(old)
        deleted = n["old"] + in_border["gone"]
        return {"rows_before": n["all"], "rows_deleted": deleted, "rows_after": n["all"] - deleted, "days_dropped": len(old), "days_rewritten": int(bool(in_border["gone"] and in_border["kept"]))}


_LOG = "table_name string, rows_before long, rows_deleted long, rows_after long, days_dropped int, days_rewritten int, status string, message string"


def retention_run(spark: SparkSession, tables: dict[str, DatedTable | DataFrame], days: int, as_of: datetime.datetime, pattern: str = "*", excluded: Sequence[str] = ()) -> DataFrame:
    """Delete what is older than days before as_of from every table whose name matches the pattern and that isn't excluded; the log
    has a row for each: SUCCESS, SKIPPED (a table without a date), or FAILED, which doesn't stop the others. No table, no rows."""
    import fnmatch

    out = []
    for name in sorted(n for n in tables if fnmatch.fnmatchcase(n, pattern) and n not in excluded):
        table = tables[name]
        try:
            if isinstance(table, DatedTable):
                log = table.delete_before(as_of - datetime.timedelta(days=days))
                out.append((name, *log.values(), "SUCCESS", None))
            else:
                n = table.count()
                out.append((name, n, 0, n, 0, 0, "SKIPPED", "no date"))
        except Exception as e:  # noqa: BLE001
            out.append((name, None, 0, None, 0, 0, "FAILED", str(e)[:500]))
    return spark.createDataFrame(out, _LOG)


def retention_configs(spark: SparkSession, tables: dict[str, DatedTable | DataFrame], configs: Sequence[dict], as_of: datetime.datetime, name: str | None = None) -> DataFrame:
    """retention_run for every active config (name, pattern, days, excluded), in order, or for one of them; config stands first."""
    out = spark.createDataFrame([], f"config string, {_LOG}")
    for c in configs:
        if c.get("active", True) and name in (None, c["name"]):
            log = retention_run(spark, tables, c["days"], as_of, c.get("pattern", "*"), c.get("excluded", ()))
            out = out.unionByName(log.select(F.lit(c["name"]).alias("config"), "*"))
    return out


def drop_old_copies(spark: SparkSession, path: str, days: int, as_of: datetime.date, keep: int = 1) -> list[str]:
    """Remove the dated copies below path (`snapshot=YYYYMMDD`) that are older than days before as_of; the newest `keep` stay however
    old they are, and so does what has another name. The removed copies' dates; repeated, it finds none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName().partition("=") for s in fs.listStatus(top)] if fs.exists(top) else []
    dated = sorted(d for kind, _, d in names if kind == "snapshot" and len(d) == 8 and d.isdigit())
    limit = (as_of - datetime.timedelta(days=days)).strftime("%Y%m%d")
    old = [d for d in dated[: max(0, len(dated) - keep)] if d < limit]
    for d in old:
        fs.delete(hadoop.Path(f"{path}/snapshot={d}"), True)
    return old
