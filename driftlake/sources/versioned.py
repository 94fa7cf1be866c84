"""Keyed tables that are merged when they are read: a base in buckets, and files of changes that a write only adds to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from driftlake.operators.cdc import CDC_COLUMNS, null_key_filter
from driftlake.sources.manifests import Manifests

#: Rows of a bucket of the base, about, and bits of a bucket's number at most.
BUCKET_ROWS, MOST_BITS = 1 << 20, 15
#: Change files after which they become one, and after which the base takes them in once they hold a quarter of its rows.
MANY, SOME = 16, 4
#: Rows of change files that a read may meet twice with the base, to spare it a shuffle.
FEW = 1 << 16
#: What stands first of an order that is equal: a loaded row, its deletion, a deletion, a put, a reload.
LOADED, LOADED_CUT, CUT, PUT, RELOAD = range(5)


class VersionedTable(Manifests):
    """A table of one row a key. A version is a manifest that names the base, the change files on it and the batches taken in.

    Base and change files hold states: the last put of a key with its place in the order (`_put`), and in tables with the
    columns of change data capture the first put's place, the time of creation and the last deletion. States of a key are
    folded by the greatest place, so that it doesn't matter in which order, in how many batches or how often changes arrive: the
    result is that of a replay in their order. A write adds a file as long as its batch; reading folds it into the
    base rows of its keys. order: columns of the changes, `name` or `name type`; without one, versions are the order, and
    within a batch puts come after deletions, then the greater row_id."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS):
        super().__init__(spark, path)
        self.keys, self.bucket_rows = list(keys), bucket_rows
        self.order = [tuple(c.split(" ", 1)) if " " in c else (c, None) for c in order]
        found = self.manifest()
        if found["schema"] and (found["keys"] != self.keys or order and [n for n, _ in self.order] != [n for n, _ in found["order"]]):
            raise ValueError(f"{path} has the keys {found['keys']} in the order of {found['order']}")

    def _nothing(self) -> dict:
        return {"version": -1, "base": None, "deltas": [], "applied": {}, "schema": None}

    def _folders(self, m: dict) -> set[str]:
        return {f["at"] for f in (m["base"], *m["deltas"])}

    # --- states ---

    def _values(self, schema: StructType) -> list[str]:
        return [f.name for f in schema.fields if f.name not in self.keys and not (self._cdc(schema) and f.name in CDC_COLUMNS)]

    @staticmethod
    def _cdc(schema: StructType) -> bool:
        return set(CDC_COLUMNS) <= set(schema.names)

    def _place(self, m: dict, df: DataFrame, rank: Column, tie: Column) -> Column:
        """Where a change stands in the order; null parts stand first."""
        cols = [(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(f"o{i}") for i, (c, kind) in enumerate(m["order"])]
        return F.struct(*(cols or [F.lit(m["version"]).cast("long").alias("o0")]), rank.cast("int").alias("rank"), F.coalesce(tie.cast("string"), F.lit("")).alias("tie"))

    def _loaded(self, m: dict, df: DataFrame) -> DataFrame:
        values = self._values(df.schema)
        at = self._place(m, df, F.lit(LOADED), F.xxhash64(*values) if values else F.lit(0))
        if not self._cdc(df.schema):
            return df.select(*self.keys, F.struct(at.alias("o"), F.struct(*values).alias("v")).alias("_put"))
        told = [F.col("cdc_operation").alias("l"), F.col("cdc_timestamp").alias("t"), F.col("record_updated_at").alias("w"), F.col("source_load_batch_id").alias("b")]
        cut = F.when(F.col("is_deleted"), F.struct(self._place(m, df, F.lit(LOADED_CUT), F.lit("")).alias("o"), *told))
        put = F.struct(at.alias("o"), F.struct(*values).alias("v"), F.lit(False).alias("u"), *told)
        return df.select(*self.keys, put.alias("_put"), at.alias("_first"), F.col("record_created_at").alias("_new"), cut.alias("_cut"))

    def _changed(self, m: dict, batch: DataFrame, as_of: Column, batch_id: str, reload: bool) -> DataFrame:
        schema = StructType.fromJson(m["schema"])
        if lost := [c for c, _ in m["order"] if c not in batch.columns]:
            raise ValueError(f"changes of {self.path} lack {lost}, which their order needs")
        values, live = self._values(schema), null_key_filter(batch, self.keys)
        cast = [F.col(c).cast(schema[c].dataType).alias(c) for c in values]
        keys = [F.col(k).cast(schema[k].dataType).alias(k) for k in self.keys]
        if not self._cdc(schema):
            at = self._place(m, live, F.lit(LOADED), F.xxhash64(*values) if values else F.lit(0))
            return live.select(*keys, F.struct(at.alias("o"), F.struct(*cast).alias("v")).alias("_put"))
        is_put = F.col("cdc_action") == "INSERT"
        live = live.where(is_put | ((F.col("cdc_action") == "DELETE") & ~F.col("cdc_is_update")))
        at = self._place(m, live, F.when(is_put, RELOAD if reload else PUT).otherwise(CUT), F.col("row_id"))
        t, w = (as_of.cast(schema[c].dataType) for c in ("cdc_timestamp", "record_updated_at"))
        told = [F.lit("RELOADED" if reload else None).cast("string").alias("l"), t.alias("t"), w.alias("w"), F.lit(batch_id).alias("b")]
        put = F.when(is_put, F.struct(at.alias("o"), F.struct(*cast).alias("v"), F.col("cdc_is_update").alias("u"), *told))
        cut = F.when(~is_put, F.struct(at.alias("o"), *told))
        new = F.when(is_put, as_of.cast(schema["record_created_at"].dataType))
        return live.select(*keys, put.alias("_put"), F.when(is_put, at).alias("_first"), new.alias("_new"), cut.alias("_cut"))

    def _folded(self, states: DataFrame) -> DataFrame:
        last = [F.max_by(c, f"{c}.o").alias(c) for c in ("_put", "_cut") if c in states.columns]
        least = [F.min(c).alias(c) for c in ("_first", "_new") if c in states.columns]
        return states.groupBy(*self.keys).agg(*last, *least).select(*states.columns)

    def _with(self, base: DataFrame, changes: DataFrame, few: bool) -> DataFrame:
        """The base's states with those of changes (one a key): one full join; of few changes a left join, in which Spark need not shuffle
        the base, and the changes of new keys, which come from a join of keys alone."""
        rest = [c for c in base.columns if c not in self.keys]
        d = changes.select(*self.keys, F.struct(*rest).alias("__d"))
        both = base.join(d, self.keys, "left" if few else "full")
        new = lambda c: F.col(f"__d.{c}")
        cols = []
        for c in rest:
            if c in ("_put", "_cut"):
                later = F.col(c).isNull() | (new(c)["o"] >= F.col(c)["o"])
                cols.append(F.when(new(c).isNotNull() & later, new(c)).otherwise(F.col(c)).alias(c))
            else:
                cols.append(F.least(F.col(c), new(c)).alias(c))
        if not few:
            return both.select(*self.keys, *cols)
        known = base.select(*self.keys).join(changes.select(*self.keys), self.keys, "left_semi")
        return both.select(*self.keys, *cols).unionByName(changes.join(known, self.keys, "left_anti"))

    def _visible(self, states: DataFrame, schema: StructType) -> DataFrame:
        """Rows as a user sees them; deletions of keys that were never put aren't any."""
        values = [F.col("_put.v")[c].alias(c) for c in self._values(schema)]
        if not self._cdc(schema):
            return states.select(*self.keys, *values).select(*schema.names)
        put, cut = F.col("_put"), F.col("_cut")
        gone = F.coalesce(cut["o"] > put["o"], F.lit(False))
        known = F.col("_first") < put["o"]
        reloaded = put["l"] == "RELOADED"
        label = F.when(put["l"].isNotNull() & ~reloaded, put["l"]).when(reloaded & known, "RELOADED").when(~F.coalesce(reloaded, F.lit(False)) & put["u"] & known, "UPDATE").otherwise("INSERT")
        last = lambda c: F.when(gone, cut[c]).otherwise(put[c])
        own = {"cdc_operation": F.when(gone, F.coalesce(cut["l"], F.lit("DELETE"))).otherwise(label), "cdc_timestamp": last("t"), "is_deleted": gone, "record_created_at": F.col("_new"), "record_updated_at": last("w"), "source_load_batch_id": last("b")}
        return states.where("_put is not null").select(*self.keys, *values, *[own[c].alias(c) for c in CDC_COLUMNS]).select(*schema.names)

    # --- files ---

    def _prefix(self, bits: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - bits).cast("int") if bits else F.lit(0)

    def _base(self, m: dict) -> DataFrame:
        schema = StructType([*StructType.fromJson(m["states"]).fields, StructField("prefix", IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{m['base']['at']}")

    def _changes(self, m: dict) -> DataFrame | None:
        if not m["deltas"]:
            return None
        paths = [f"{self.path}/data/{d['at']}" for d in m["deltas"]]
        rows = self.spark.read.schema(StructType.fromJson(m["states"])).parquet(*paths)
        # a file has a key once, so that its rows are dealt out before they are folded
        return self._folded(rows.repartition(*self.keys)) if len(paths) > 1 else rows

    def _states(self, m: dict) -> DataFrame:
        base, changes = self._base(m), self._changes(m)
        if changes is None:
            return base.drop("prefix")
        few = sum(d["rows"] for d in m["deltas"]) <= FEW
        touched = sorted({p for d in m["deltas"] for p in _numbers(d["touched"])})
        if len(touched) < 1 << m["base"]["bits"]:
            cold = base.where(~F.col("prefix").isin(touched)).drop("prefix")
            return self._with(base.where(F.col("prefix").isin(touched)).drop("prefix"), changes, few).unionByName(cold)
        return self._with(base.drop("prefix"), changes, few)

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version (the newest)."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._visible(self._states(m), StructType.fromJson(m["schema"]))

    def _new_base(self, states: DataFrame, rows: int) -> dict:
        """A base in as many buckets, by the first bits of the keys' hash, as rows ask for."""
        bits = min(MOST_BITS, max(0, (rows - 1) // self.bucket_rows).bit_length())
        at, seen = uuid.uuid4().hex, Observation()
        keyed = states.withColumn("prefix", self._prefix(bits)).observe(seen, F.count(F.lit(1)).alias("n"))
        keyed.repartition(1 << bits, "prefix").write.partitionBy("prefix").parquet(f"{self.path}/data/{at}")
        if not seen.get["n"]:
            states.write.parquet(f"{self.path}/data/{at}/prefix=0")
        return {"at": at, "bits": bits, "rows": seen.get["n"]}

    def write(self, df: DataFrame, applied: dict | None = None) -> int:
        """The next version, of the rows of df (one a key) alone."""
        m = self.manifest()
        order = m.get("order") or [[n, kind or (df.schema[n].dataType.simpleString() if n in df.columns else "bigint")] for n, kind in self.order]
        m = {"version": m["version"] + 1, "keys": self.keys, "order": order, "schema": df.schema.jsonValue(), "applied": {**m["applied"], **(applied or {})}, "deltas": []}
        states = self._loaded(m, df)
        m["states"] = states.schema.jsonValue()
        return self._commit({**m, "base": self._new_base(states, df.count())})

    def _new_delta(self, m: dict, states: DataFrame) -> dict:
        at, seen = uuid.uuid4().hex, Observation()
        p = self._prefix(m["base"]["bits"]).cast("long")
        marked = self._folded(states).observe(seen, F.count(F.lit(1)).alias("n"), F.hex(F.bitmap_construct_agg(p)).alias("touched"))
        marked.write.parquet(f"{self.path}/data/{at}")
        return {"at": at, "rows": seen.get["n"], "touched": seen.get["touched"]}

    def append(self, batch: DataFrame, as_of: Column | None = None, batch_id: str = "", applied: dict | None = None, reload: bool = False) -> int:
        """The next version: the changes of batch on top, in a file of as many rows as it has keys. Rows of null keys and old images
        of updates are left out."""
        m = self.manifest()
        if m["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        m = {**m, "version": m["version"] + 1, "applied": {**m["applied"], **(applied or {})}}
        states = self._changed(m, batch, F.current_timestamp() if as_of is None else as_of, batch_id, reload)
        # a reload has about a row a key: folding before the shuffle would only sort it twice
        delta = self._new_delta(m, states.repartition(*self.keys) if reload else states)
        return self._commit({**m, "deltas": [*m["deltas"], *([delta] if delta["rows"] else [])]})

    def tend(self) -> int:
        """Make one file of many change files, or a new base, in other buckets if it has grown, once changes are a quarter of it:
        so each row is written again a bounded number of times. The newest version's number."""
        m = self.manifest()
        rows = sum(d["rows"] for d in m["deltas"])
        if len(m["deltas"]) >= SOME and 4 * rows >= m["base"]["rows"]:
            return self.compact()
        if len(m["deltas"]) >= MANY:
            states = self.spark.read.schema(StructType.fromJson(m["states"])).parquet(*[f"{self.path}/data/{d['at']}" for d in m["deltas"]])
            return self._commit({**m, "version": m["version"] + 1, "deltas": [self._new_delta(m, states)]})
        return m["version"]

    def compact(self) -> int:
        """A new base that has taken the change files in."""
        m = self.manifest()
        rows = m["base"]["rows"] + sum(d["rows"] for d in m["deltas"])
        return self._commit({**m, "version": m["version"] + 1, "base": self._new_base(self._states(m), rows), "deltas": []})


def _numbers(hexed: str) -> list[int]:
    """The set bits of a bitmap."""
    return [8 * i + k for i, byte in enumerate(bytes.fromhex(hexed)) if byte for k in range(8) if byte >> k & 1]
