"""Exact self-join of documents on the Jaccard distance of their word shingles, by pivots and triangle windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.components import connected_components
from driftlake.llm.scratch import may_be_among, ship, write_shared
from driftlake.llm.words import WORD_BASE, Block, ids_of, mix, run_hashes, signed, sliding_min, text_blocks

#: Word counts are kept by 2**WORD_BITS buckets of the word's hash: 2 MB, however many words there are.
WORD_BITS = 18
#: A sketch has a count for every four to eight of the set's hashes: at least 2**LOW_BITS and at most 2**HIGH_BITS counts.
LOW_BITS, HIGH_BITS = 4, 16
#: Pivots of a cell held at once, about.
BLOCK = 64
#: Documents compared with one pivot in one task.
SALTED = 512
ROUNDED = 1e-9


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << WORD_BITS, np.int64)
    for batch in batches:
        for block in text_blocks(batch):
            total += np.bincount((block.words >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def _shingles(block: Block, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each document's distinct shingle hashes, sorted; all its words as one where it has fewer than k, none without words."""
    hashes, _ = block.grams(k)
    for doc in range(block.n_docs):
        lo, hi = block.bounds[doc], block.bounds[doc + 1]
        if hi - lo >= k:
            yield doc, np.unique(hashes[lo : hi - k + 1])
        elif hi > lo:
            yield doc, run_hashes(block.words[lo:hi], np.array([0]), np.array([hi - lo]), WORD_BASE)
        else:
            yield doc, hashes[:0]


def _sketch(have: np.ndarray) -> bytes:
    """How many of a set's hashes fall in each class, by their first bits; more classes for larger sets. The sum of two
    sketches' differences is at most the size of the symmetric difference of the sets: a metric bound that costs no texts."""
    bits = min(HIGH_BITS, max(LOW_BITS, (len(have) // 8).bit_length()))
    return np.minimum(np.bincount((have >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch that the same set has with fewer classes."""
    return np.minimum(sketch.reshape(size, -1).sum(1, dtype=np.int64), 255).astype(np.int32)


def _signed_sets(levels, k: int, percent: int):
    """Size and digest of each document's set, and the rarest shingles of it, of which a linked set has at least one."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            ids, known = ids_of(batch, "id")
            rows = []
            for block in text_blocks(batch):
                hashes, _ = block.grams(k)
                of_word = level[(block.words >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
                keys = sliding_min(of_word, k).astype(np.uint64) << np.uint64(56) | hashes >> np.uint64(8)
                for doc, have in _shingles(block, k):
                    lo, hi = block.bounds[doc], block.bounds[doc + 1]
                    n = len(have)
                    if hi - lo >= k:
                        own = np.unique(keys[lo : hi - k + 1])
                    else:
                        own = have >> np.uint64(8)
                    take = n - (percent * n + 99) // 100 + 1 if n else 0
                    rows.append((n, int(signed(have.sum(keepdims=True, dtype=np.uint64))[0]) if n else 0, int(signed(mix(have ^ np.uint64(WORD_BASE)).sum(keepdims=True, dtype=np.uint64))[0]) if n else 0, signed(own[: take if known[block.first + doc] else 0]), _sketch(have)))
            n, a, b, rare, sketch = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            sizes = np.cumsum([0, *map(len, rare)])
            lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.concatenate(rare) if rows else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), lists, pa.array(sketch, pa.binary())], ["id", "n", "a", "b", "rare", "sketch"])

    return go


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key another row has."""
    last, last_same = None, False
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([last, table]) if last is not None else table
        keys = table.column("key").to_numpy()
        if not len(keys):
            continue
        same = keys[1:] == keys[:-1]
        keep = np.r_[last_same, same] | np.r_[same, False]
        last, last_same = table.slice(len(keys) - 1), bool(same[-1]) if len(same) else last_same
        keep[-1] = False
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches()
    if last is not None and last_same:
        yield from last.combine_chunks().to_batches()


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) and len(b) else 0


def _distances(k: int):
    """Sizes of the intersections with the pivot, whose text comes first among the rows of its group."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, of = None, np.zeros(0, np.uint64)
        for batch in batches:
            ids, pivots, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "pivot", "other"))
            out = []
            for block in text_blocks(batch):
                for doc, have in _shingles(block, k):
                    i = block.first + doc
                    if not first[i]:
                        pivot, of = int(pivots[i]), have
                    elif pivot == pivots[i]:
                        out.append((int(ids[i]), pivot, _common(of, have), len(have), len(of)))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(5)], ["id", "pivot", "common", "n_id", "n_pivot"])

    return go


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least sizes of the symmetric difference with the pivot, whose sketch comes first among the rows of its group, and
    the sum of both sets' sizes."""
    pivot, of, of_n = None, None, 0
    for batch in batches:
        ids, pivots, other, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "pivot", "other", "n"))
        out = []
        for i, sketch in enumerate(batch.column("sketch")):
            own = np.frombuffer(sketch.as_py(), np.uint8)
            if not other[i]:
                pivot, of, of_n = int(pivots[i]), own, int(n[i])
            elif pivot == pivots[i]:
                size = min(len(of), len(own))
                out.append((int(ids[i]), pivot, int(np.abs(_folded(of, size) - _folded(own, size)).sum()), of_n + int(n[i])))
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(4)], ["id", "pivot", "apart", "both"])


def _cell_links(k: int, percent: int):
    """Links of each cell's documents with its pivots (which come first) that belong to another component."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, pivots = None, []
        for batch in batches:
            ids, cells, parts, comps, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "cell", "part", "component", "other"))
            out = []
            for block in text_blocks(batch):
                for doc, have in _shingles(block, k):
                    i = block.first + doc
                    if (cells[i], parts[i]) != name:
                        name, pivots = (cells[i], parts[i]), []
                    if not other[i]:
                        pivots.append((int(ids[i]), comps[i], have))
                        continue
                    joined = set()
                    for pivot, comp, of in pivots:
                        if comp != comps[i] and comp not in joined and 100 * min(len(of), len(have)) >= percent * max(len(of), len(have)):
                            both = _common(of, have)
                            if 100 * both >= percent * (len(of) + len(have) - both):
                                joined.add(comp)
                                out.append((int(ids[i]), pivot))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(2)], ["u", "v"])

    return go


def _cell_candidates(percent: int):
    """Documents and pivots of other components, of each cell, that their sketches let be within the radius."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, pivots, tables = None, [], {}

        def table(size: int, finer: bool):
            """Pivots whose sketches have so many classes (finer: or more, folded): ids, components, set sizes, sketches."""
            if (size, finer) not in tables:
                of = [p for p in pivots if len(p[3]) == size or finer and len(p[3]) > size]
                tables[size, finer] = (*(np.array([p[j] for p in of], np.int64) for j in range(3)), np.array([_folded(p[3], size) for p in of])) if of else None
            return tables[size, finer]

        for batch in batches:
            ids, cells, parts, comps, n, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "cell", "part", "component", "n", "other"))
            out = set()
            for i, sketch in enumerate(batch.column("sketch")):
                if (cells[i], parts[i]) != name:
                    name, pivots, tables = (cells[i], parts[i]), [], {}
                own = np.frombuffer(sketch.as_py(), np.uint8)
                if not other[i]:
                    pivots.append((ids[i], comps[i], n[i], own))
                    tables = {}
                    continue
                for size in {min(len(p[3]), len(own)) for p in pivots}:
                    if (met := table(size, size == len(own))) is None:
                        continue
                    of, comp, sizes, counts = met
                    may = np.flatnonzero((comp != comps[i]) & (100 * np.minimum(sizes, n[i]) >= percent * np.maximum(sizes, n[i])))
                    if not len(may):
                        continue
                    apart = np.abs(counts[may] - _folded(own, size)).sum(1)
                    near = of[may[apart * (100 + percent) <= (100 - percent) * (sizes[may] + int(n[i]))]]
                    if len(near):
                        out.add((int(cells[i]), int(ids[i])))
                        out.update((int(cells[i]), int(p)) for p in near)
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(2)], ["cell", "id"])

    return go


def _dealt(cells: DataFrame) -> DataFrame:
    """Each cell's documents (other) with every block of its pivots (component <> cell); hot cells in salted parts."""
    outside = cells.where("component <> cell")
    parts = outside.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    salts = cells.groupBy("cell").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    by = cells.join(parts, "cell").join(salts, "cell")
    each = by.select("cell", "id", "component", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("other"))
    first = by.where("component <> cell").select("cell", "id", "component", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("other"))
    return each.unionByName(first)


def _gathered(rows: DataFrame) -> DataFrame:
    met = rows.repartition(F.col("cell"), F.col("part"), F.col("salt")).sortWithinPartitions("cell", "part", "salt", "other")
    return met.withColumn("part", F.struct("part", "salt").cast("string"))


def _different(members: DataFrame) -> DataFrame:
    """One of each set of regions that have the same documents, and none of fewer than two."""
    of = members.groupBy("region").agg(F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("digest"))
    one = of.where("size > 1").groupBy("size", "digest").agg(F.min("region").alias("region"))
    return members.join(one.select("region", "size"), "region")


def _of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of ids, and few others: a Bloom filter tells, so that no others are shuffled."""
    return texts.where(may_be_among(ids.toDF("id").distinct(), F.col("id")))


def _by_pivot(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """The columns of each pair's document and pivot, gathered by pivot, which comes first; hot pivots in salted parts."""
    fan = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    salted = pairs.join(fan, "pivot").select("id", "pivot", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("other"))
    first = fan.select(F.col("pivot").alias("id"), "pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("other"))
    rows = salted.unionByName(first).join(of, "id").repartition(F.col("pivot"), F.col("salt")).sortWithinPartitions("pivot", "salt", "other")
    return rows.select("id", "pivot", "other", *columns)


def _compare(members: DataFrame, sketches: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Each region's documents with their region's pivot and exact or least possible distance from it.

    The pivot is the member found in most regions: the original of a group of copies, as a rule."""
    often = members.groupBy("id").agg(F.count("*").alias("regions"))
    ranked = members.join(often, "id")
    pivots = ranked.groupBy("region").agg(F.max(F.struct("regions", (-F.col("id")).alias("id"), "n")).alias("best"))
    starred = members.join(pivots.select("region", (-F.col("best.id")).alias("pivot"), F.col("best.n").alias("n_pivot")), "region").where("id <> pivot")
    near = 100 * F.least("n", "n_pivot") >= percent * F.greatest("n", "n_pivot")
    pairs = starred.where(near).select("id", "pivot").distinct()
    rows = _by_pivot(pairs, sketches, "sketch", "n")
    apart = write_shared(rows.mapInArrow(_apart, "id long, pivot long, apart long, both long"), "apart")
    may = apart.where((100 + percent) * F.col("apart") <= (100 - percent) * F.col("both")).select("id", "pivot")
    found = _by_pivot(may, _of(texts, may.select("id").union(may.select("pivot"))), "text").mapInArrow(_distances(k), "id long, pivot long, common long, n_id long, n_pivot long")
    found = found.select("id", "pivot", "common", (F.col("n_id") + F.col("n_pivot") - F.col("common")).alias("either")).dropDuplicates(["id", "pivot"])
    return starred.join(apart.join(found, ["id", "pivot"], "left"), ["id", "pivot"], "left")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose sets of k-word shingles have a Jaccard similarity of percent / 100 or more; exact.

    Jaccard distance is a metric. Equal sets fall together first. The first pivots are single shingles: a set's region
    is that of each of its rarest shingles (rarity: the count of the shingle's rarest word, over all documents), so many
    of them that a set within the radius must share one; that is the window by which boundary documents are replicated.
    Passages that many documents share have frequent words and so come last. Then each region takes a document for its
    pivot, and distances from it split the region (exact ones where sketches allow a link, else their lower bound):
    documents within the radius are linked; the others go on, together with those of the linked that the triangle
    inequality lets be within the radius of one of them. What is left
    of the regions forms the cells of a second level: regions meet in the cell of the component that most of their
    documents already belong to. All documents of a cell that are not of that component are its pivots, in blocks, and
    the cell's documents are compared with them exactly, where their sketches (counts of a set's hashes by class, whose
    distance is never above the sets') allow a link; those of one component need no comparison with each other.

    Words are lower-cased (A-Z) runs of characters other than space and \\x09-\\x0D. A document of fewer than k words has
    all of them as its one shingle; null or empty text has no shingles and no links. A null id takes no part. Rows that repeat are
    one document; of an id with several texts each row has the class of its own set, and the id stands for any of them when classes
    are compared. Empty tables give no rows; texts of any length are read whole. Returns
    id, n_shingles, component_id (smallest id reachable, itself included), a row for each row of docs.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_word_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    level = np.zeros(1 << WORD_BITS, np.uint8)
    level[counts["bucket"].to_numpy()] = np.minimum(255, 4 * np.log2(counts["n"].to_numpy()))
    levels = spark.sparkContext.broadcast(level)
    sets = write_shared(texts.mapInArrow(_signed_sets(levels, k, percent), "id long, n int, a long, b long, rare array<long>, sketch binary"), "sets")
    classes = sets.where("n > 0").groupBy("n", "a", "b").agg(F.min("id").alias("rep"))
    whole = sets.where("n > 0 and size(rare) > 0").join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    placed = whole.select(F.explode("rare").alias("key"), "id", "n").repartition(F.col("key")).sortWithinPartitions("key")
    shared = write_shared(placed.mapInArrow(_shared_rows, "key long, id long, n int").select(F.col("key").alias("region"), "id", "n"), "regions")
    members = write_shared(_different(shared.distinct()), "members")
    sketches = sets.select("id", "n", "sketch").where("n > 0").dropDuplicates(["id"])
    compared = write_shared(_compare(members, sketches, texts, k, percent), "compared")
    is_link = F.coalesce(100 * F.col("common") >= percent * F.col("either"), F.lit(False))
    links = write_shared(compared.where(is_link).select(F.col("id").alias("u"), F.col("pivot").alias("v")).distinct(), "links")
    label = connected_components(links).withColumnRenamed("node", "id")
    far = F.coalesce(1 - F.col("common") / F.col("either"), 2 * F.col("apart") / (F.col("both") + F.col("apart")), 1 - F.least("n", "n_pivot") / F.greatest("n", "n_pivot"))
    measured = compared.select("region", "id", is_link.alias("linked"), far.alias("far"))
    edge = measured.where("not linked").groupBy("region").agg(F.min("far").alias("nearest"))
    radius = 1 - percent / 100
    kept = measured.join(edge, "region").where((~F.col("linked")) | ((F.col("far") + radius + ROUNDED >= F.col("nearest")) & (F.col("nearest") <= 2 * radius + ROUNDED)))
    placed = write_shared(_different(kept.select("region", "id")).join(label, "id", "left").select("region", "id", F.coalesce("component", "id").alias("component")), "placed")
    held = placed.groupBy("region", "component").agg(F.count("*").alias("n")).groupBy("region").agg(F.max(F.struct("n", (-F.col("component")).alias("c"))).alias("most"), F.count("*").alias("components"))
    cells = placed.join(held.where("components > 1").select("region", (-F.col("most.c")).alias("cell")), "region").select("cell", "id", "component").distinct()
    cells = write_shared(cells, "cells")
    drawn = _gathered(_dealt(cells).join(sketches, "id"))
    may = drawn.select("id", "cell", "part", "component", "n", "other", "sketch").mapInArrow(_cell_candidates(percent), "cell long, id long")
    cells = write_shared(cells.join(may.distinct(), ["cell", "id"], "left_semi"), "near_cells")
    rows = _gathered(_dealt(cells).join(_of(texts, cells.select("id")), "id"))
    more = rows.select("id", "cell", "part", "component", "other", "text").mapInArrow(_cell_links(k, percent), "u long, v long").distinct()
    links = links.unionByName(write_shared(more, "more"))
    label = connected_components(links)
    known = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("n", "a", "b", F.coalesce("component", "rep").alias("component_id"))
    of = sets.select("id", "n", "a", "b").join(known, ["n", "a", "b"], "left")
    return of.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))

