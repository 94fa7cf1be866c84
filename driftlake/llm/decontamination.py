"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import bitmap, in_bitmap, ship, write_shared
from driftlake.llm.words import PUNCT, ids_of, signed, text_blocks


def _runs(seeds: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The longest runs of shared seeds: place in the test, place in the text, and how many seeds follow each other there.

    seeds: each shared seed's places in the text and in the test. Few pairs of places are ordered by diagonal; where a seed
    repeats on both sides, the test is passed over from its end, and only one row of lengths is kept, never the pairs."""
    if sum(len(p) * len(q) for p, q in seeds) <= PAIRS:
        at = np.concatenate([np.tile(p, len(q)) for p, q in seeds])
        of = np.concatenate([np.repeat(q, len(p)) for p, q in seeds])
        at, of = np.unique(np.stack([at - of, at, of], 1), axis=0)[:, 1:].T
        new = np.r_[True, (np.diff(at) != 1) | (np.diff(of) != 1)]
        first = np.flatnonzero(new)
        return of[first], at[first], np.diff(np.r_[first, len(at)])
    seeds = [(np.unique(p), np.unique(q)) for p, q in seeds]
    places: dict[int, list[int]] = {}
    for i, (_, q) in enumerate(seeds):
        for x in q.tolist():
            places.setdefault(x, []).append(i)
    size = int(max(p.max() for p, _ in seeds)) + 3
    after, before = np.zeros(size, np.int32), -1
    held, out = np.zeros(0, np.int64), []
    for x in sorted(places, reverse=True):
        row = np.zeros(size, np.int32)
        own = places[x]
        at = (seeds[own[0]][0] if len(own) == 1 else np.unique(np.concatenate([seeds[i][0] for i in own]))) + 1
        row[at] = (after[at + 1] if before == x + 1 else 0) + 1
        if before >= 0:
            starts = held[row[held - 1] == 0] if before == x + 1 else held
            out.append((np.full(len(starts), before), starts - 1, after[starts]))
        after, before, held = row, x, at
    out.append((np.full(len(held), before), held - 1, after[held]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def tiles(seeds: list[tuple[np.ndarray, np.ndarray]], seed: int, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from shared seeds (of each its places in the text, and in the test of n words): longest matches first.

    Returns (place in text, place in test, length); no word on either side is in two tiles. Of equal lengths the
    one earlier in the test, then in the text, comes first."""
    of, at, counts = _runs(seeds)
    heap = list(zip((-counts.astype(np.int64) - seed + 1).tolist(), of.tolist(), at.tolist(), strict=True))
    heapq.heapify(heap)
    in_test, in_text, out = bytearray(n), bytearray(max((p - k for k, _, p in heap), default=0)), []
    free = n
    while heap and free >= seed:
        k, q, p = heapq.heappop(heap)
        k = -k
        own, other = in_test[q : q + k], in_text[p : p + k]
        if 1 not in own and 1 not in other:
            out.append((p, q, k))
            in_test[q : q + k] = in_text[p : p + k] = b"\1" * k
            free -= k
        elif 0 in own and 0 in other:
            taken = np.frombuffer(own, np.uint8) | np.frombuffer(other, np.uint8)
            edges = np.flatnonzero(np.diff(np.r_[1, taken, 1].astype(np.int8)))
            for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if hi - lo >= seed:
                    heapq.heappush(heap, (lo - hi, q + lo, p + lo))
    return out


#: Pairs of places of shared seeds, of a document and an item, that are listed at once.
PAIRS = 1 << 20


def _item_seeds(k: int):
    """Runs of k words of each item; of a shorter item, all its words as one run."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known = ids_of(batch, "id")
            for block in text_blocks(batch, separators=PUNCT):
                size = np.diff(block.bounds)
                for width in range(1, k + 1):
                    hashes, whole = block.grams(width)
                    doc = block.doc[: len(hashes)]
                    fits = size[doc] >= k if width == k else size[doc] == width
                    at = np.flatnonzero(whole & fits & known[block.first + doc])
                    doc = doc[at]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(hashes[at])), pa.array(ids[block.first + doc]), pa.array((at - block.bounds[doc]).astype(np.int32)), pa.array(size[doc].astype(np.int32))], ["seed", "item_id", "q", "n"])

    return go


def _text_seeds(bits, widths: list[int]):
    """Runs of the widths that the items have, where they may be an item's."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known = ids_of(batch, "id")
            for block in text_blocks(batch, separators=PUNCT):
                for width in widths:
                    hashes, whole = block.grams(width)
                    at = np.flatnonzero(whole)
                    at = at[in_bitmap(bits.value, hashes[at])]
                    rows = block.first + block.doc[at]
                    at, rows = at[known[rows]], rows[known[rows]]
                    place = (at - block.bounds[block.doc[at]]).astype(np.int32)
                    order = np.lexsort((place, hashes[at], rows))
                    key, row, place = hashes[at][order], rows[order], place[order]
                    head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])]) if len(key) else np.zeros(0, np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[head, len(key)].astype(np.int32)), pa.array(place))
                    yield pa.RecordBatch.from_arrays([pa.array(signed(key[head])), pa.array(ids[row[head]]), lists], ["seed", "id", "ps"])

    return go


def _tiled(k: int):
    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                found = tiles([(np.asarray(x["ps"], np.int64), np.asarray(x["qs"], np.int64)) for x in r.at], min(k, r.n), r.n)
                rows.append((r.id, r.item_id, len(found), sum(t[2] for t in found), r.n))
            yield pd.DataFrame(rows, columns=["id", "item_id", "n_tiles", "matched_tokens", "item_tokens"])

    return go


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", tile: int = 5, coverage: float = 0.5) -> DataFrame:
    """Pairs of documents and benchmark items of whose words at least `coverage` lie in tiles of `tile` or more words.

    Rolling Karp-Rabin hashes of every run of `tile` words are the seeds; those of the items fill a filter,
    which lets few runs of the documents through, and Spark joins these with the items' seeds: a row for each seed that a document and
    an item share, with its places on either side, so that repeated words don't multiply. Greedy string
    tiling then covers each pair's item, so that reordered passages count in full. An item of fewer than `tile` words is a
    tile of its own length: it is found where all its words stand in order. Words are lower-cased (A-Z)
    runs of characters other than white space and ASCII punctuation. Null and empty texts and null ids have no match. Rows
    that repeat an id count as one document, or item, whose texts are tiled together; empty tables have no pairs; texts of any
    length are read whole. Returns id, item_id, n_tiles, matched_tokens, item_tokens, coverage.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.dropDuplicates()
    seeds = write_shared(items.mapInArrow(_item_seeds(tile), "seed long, item_id long, q int, n int"), "seeds")
    widths = sorted(r["w"] for r in seeds.select(F.least("n", F.lit(tile)).alias("w")).distinct().collect())
    bits = spark.sparkContext.broadcast(bitmap(seeds, F.col("seed")))
    hits = texts.mapInArrow(_text_seeds(bits, widths), "seed long, id long, ps array<int>")
    known = seeds.groupBy("seed", "item_id", "n").agg(F.collect_set("q").alias("qs"))
    pairs = hits.join(known, "seed").groupBy("id", "item_id", "n").agg(F.collect_list(F.struct("ps", "qs")).alias("at"))
    # what seeds cover at most: each place of the item adds no more than a tile's words
    most = F.aggregate("at", F.lit(0), lambda s, x: s + F.size(x["qs"]))
    pairs = pairs.where(tile * most >= coverage * F.col("n"))
    found = pairs.select("id", "item_id", "at", "n").mapInPandas(_tiled(tile), "id long, item_id long, n_tiles long, matched_tokens long, item_tokens long")
    share = F.col("matched_tokens") / F.col("item_tokens")
    return found.withColumn("coverage", share).where(F.col("coverage") >= coverage).withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_col)
