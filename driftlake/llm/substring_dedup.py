"""Exact substring deduplication: repeated word windows, by Rabin-Karp hashes counted in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import bitmap, in_bitmap, ship
from driftlake.llm.words import AS_IS, Block, ids_of, mix, signed, sliding_min, text_blocks

#: Words of the runs whose least hash stands for a window when shared windows are first searched.
GRAM = 16
#: Windows that a map task sorts at once before it sends them.
HELD = 600_000
#: Texts taken apart at once.
ROWS = 500


def _least(block: Block, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, _ = block.grams(gram)
    least = sliding_min(hashes, window - gram + 1)
    n = len(least)
    return least, block.doc[:n] == block.doc[window - 1 : window - 1 + n]


def _anchors(window: int, gram: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known = ids_of(batch, "id")
            for block in text_blocks(batch, fold=AS_IS):
                least, whole = _least(block, window, gram)
                rows = block.first + block.doc[: len(least)]
                keep = whole & known[rows]
                least, owner = least[keep], ids[rows[keep]]
                order = np.lexsort((owner, least))
                least, owner = least[order], owner[order]
                at = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(least) else np.zeros(0, np.int64)
                last = np.r_[at[1:], len(least)] - 1
                yield pa.RecordBatch.from_arrays([pa.array(signed(least[at])), pa.array(owner[at]), pa.array(owner[last])], ["anchor", "lo", "hi"])

    return go


def _candidates(bits: np.ndarray, block: Block, window: int, gram: int, known: np.ndarray) -> np.ndarray:
    least, whole = _least(block, window, gram)
    at = np.flatnonzero(whole & known[block.first + block.doc[: len(least)]])
    return at[in_bitmap(bits, least[at])]


def _send(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Windows with the smallest document of this task go on to be compared; windows of others repeat one of those."""
    key, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((doc, key))
    key, doc, pos = key[order], doc[order], pos[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    repeat = doc > np.repeat(doc[first], np.diff(np.r_[first, len(key)]))
    key = np.where(repeat, mix(mix(doc.view(np.uint64)) + pos.astype(np.uint64)), key)  # settled here: any task may pass it on
    return pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(doc), pa.array(pos.astype(np.int32)), pa.array(repeat)], ["key", "id", "pos", "repeat"])


def _windows(shared, window: int, gram: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, known = ids_of(batch, "id")
            for block in text_blocks(batch, fold=AS_IS):
                at = _candidates(shared.value, block, window, gram, known)
                if not len(at):
                    continue
                hashes, _ = block.grams(window)
                parts.append((hashes[at], ids[block.first + block.doc[at]], at - block.bounds[block.doc[at]]))
                held += len(at)
                if held > HELD:
                    yield _send(parts)
                    parts, held = [], 0
        if parts:
            yield _send(parts)

    return go


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and document, those whose key a smaller document has."""
    key, least = None, None
    for batch in batches:
        keys, docs = (batch.column(x).to_numpy() for x in ("key", "id"))
        if not len(keys):
            continue
        new = np.r_[keys[0] != key or key is None, keys[1:] != keys[:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        lo = np.where(first < 0, least if least is not None else 0, docs[first])
        key, least = keys[-1], lo[-1]
        keep = batch.column("repeat").to_numpy(zero_copy_only=False) | (docs > lo)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(docs[keep]), pa.array(batch.column("pos").to_numpy()[keep])], ["id", "pos"])


def _untouched(shared, window: int, gram: int, done: bool):
    """Texts of documents without (done) or with windows to be compared."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, known = ids_of(batch, "id")
            hit = np.zeros(batch.num_rows, bool)
            for block in text_blocks(batch, fold=AS_IS):
                hit[block.first + block.doc[_candidates(shared.value, block, window, gram, known)]] = True
            yield batch.filter(pa.array(hit != done))

    return go


RESULT = "id long, n_words long, kept_text string, removed array<struct<start:long,end:long>>"


def _cut(text: str | None, pos: np.ndarray, window: int) -> tuple[int, str, list[dict]]:
    words = (text or "").encode().split()
    if not len(pos):
        return len(words), b" ".join(words).decode(), []
    pos = np.unique(pos)
    gap = np.flatnonzero(np.diff(pos) > window)
    starts, ends = pos[np.r_[0, gap + 1]], pos[np.r_[gap, len(pos) - 1]] + window
    kept, at = [], 0
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        kept += words[at:s]
        at = e
    kept += words[at:]
    return len(words), b" ".join(kept).decode(), [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def _result(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = (pa.int64(), pa.int64(), pa.string(), span)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["id", "n_words", "kept_text", "removed"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield _result([(i, *_cut(t, none, 1)) for i, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True)])


def _merged(window: int):
    """From rows sorted by document: its text (pos -1; repeated rows have several), then the windows to remove."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, texts, pos = None, [], []

        def close() -> list[tuple]:
            marks = np.concatenate(pos) if pos else np.zeros(0, np.int64)
            return [(doc, *_cut(t, marks, window)) for t in texts]

        for batch in batches:
            docs, at = batch.column("id").to_numpy(zero_copy_only=False), batch.column("pos").to_numpy().astype(np.int64)
            bounds = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True]) if len(docs) else []
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if docs[lo] != doc:
                    out += close()
                    doc, texts, pos = int(docs[lo]), [], []
                n = int(np.searchsorted(at[lo:hi], 0))
                texts += batch.column("text").slice(lo, n).to_pylist()
                pos.append(at[lo + n : hi])
                if len(out) >= ROWS:
                    yield _result(out)
                    out = []
            if out:
                yield _result(out)
        if texts:
            yield _result(close())

    return go


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = GRAM) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts in a document of smaller id.

    Three passes over the texts. First each window is stood for by the least hash of its `gram`-word runs, which
    equal windows share; a few of a hundred positions are least anywhere, and Spark counts which of them occur in two
    documents. Then only windows with such a run are hashed whole (Rabin-Karp) and compared by Spark; a map task sends
    a window of a key once, so that a passage in a third of all documents sends a row a task. Last, texts meet their
    windows, which merge into maximal intervals.

    Nothing is dropped: the bitmap of shared runs only ever lets too many windows through. Words are runs of
    characters other than space and \\x09-\\x0D, unchanged. Null text counts as empty; a null id takes no part and loses
    nothing. Rows that repeat an id are taken for one document, and windows found in any of its texts are cut from each. An empty
    table gives no rows; texts of any length are read whole. Returns id, n_words, kept_text (kept words joined by one space) and
    removed (intervals of words, end exclusive), a row for each row of docs.
    """
    spark = docs.sparkSession
    ship(spark)
    gram = min(gram, window)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    runs = texts.mapInArrow(_anchors(window, gram), "anchor long, lo long, hi long")
    repeated = runs.groupBy("anchor").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    shared = spark.sparkContext.broadcast(bitmap(repeated, F.col("anchor")))
    windows = texts.mapInArrow(_windows(shared, window, gram), "key long, id long, pos int, repeat boolean")
    dealt = windows.repartition(F.col("key")).sortWithinPartitions("key", "id")
    marks = dealt.mapInArrow(_repeats, "id long, pos int").select("id", "pos", F.lit(None).cast("string").alias("text"))
    touched = texts.mapInArrow(_untouched(shared, window, gram, False), "id long, text string").select("id", F.lit(-1).alias("pos"), "text")
    met = marks.unionByName(touched).repartition(F.col("id")).sortWithinPartitions("id", "pos")
    whole = texts.mapInArrow(_untouched(shared, window, gram, True), "id long, text string").mapInArrow(_whole, RESULT)
    return met.mapInArrow(_merged(window), RESULT).unionByName(whole).withColumnRenamed("id", id_col)
