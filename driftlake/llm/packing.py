"""Order-preserving packing of documents into training sequences by dynamic programming."""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship
from driftlake.llm.words import AS_IS, Block, text_blocks

#: Cuts inside a document cost so many tokens of padding, at a sentence's end and elsewhere.
SENTENCE_COST, BREAK_COST = 4, 24
#: A sentence may be cut every so many tokens.
STRIDE = 64
#: Tokens packed at once; what fills no sequence goes on to the next.
BATCH_TOKENS = 1 << 19
#: Words whose ids a Python worker remembers, about, and ids of them: 60 MB.
REMEMBERED, REMEMBERED_IDS = 1_500_000, 1 << 23
#: Marks that the tokenizer always parts from a letter before them (all of ASCII but the apostrophe), the last letter
#: of the Latin blocks, and words encoded as one text.
MARKS, LATIN, JOINED = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~""", "\u024f", 64
#: What parts words for this tokenizer: a space or line break always parts tokens, so that a word always has the same ids.
PARTS = np.zeros(256, bool)
PARTS[[9, 10, 13, 32]] = True
_WORKER: dict = {}


def cuts(bounds: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Indices of the bounds that end the windows: the least sum of padding and costs, windows of at most size.

    bounds: ascending places where a window may end, 0 first; none further than size from the one before. The best
    start of a window is the least of (cost so far + place) over the places within reach, kept in a monotone queue."""
    n = len(bounds)
    total, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    places, prices = bounds.tolist(), costs.tolist()
    for j in range(1, n):
        while places[queue[0][1]] < places[j] - size:
            queue.popleft()
        value, i = queue[0]
        total[j], back[j] = value + size - places[j] + prices[j], i
        key = total[j] + places[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], n - 1
    while j:
        out.append(j)
        j = back[j]
    return out[::-1]


class Known:
    """Ids of words by the words' hashes, in a few arrays."""

    def __init__(self):
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray, codes: list[bytes]) -> None:
        """codes: little-endian unsigned 32-bit ids of each key; no key is known yet, and none comes twice."""
        if not codes:
            return
        new, n = np.frombuffer(b"".join(codes), np.uint32), np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(new), self.used), np.uint32)])
        self.ids[self.used : self.used + len(new)] = new
        order = np.argsort(keys)
        to = np.searchsorted(self.keys, keys[order])
        self.at = np.insert(self.at, to, (self.used + np.cumsum(n) - n)[order])
        self.n = np.insert(self.n, to, n[order].astype(np.int32))
        self.keys = np.insert(self.keys, to, keys[order])
        self.used += len(new)

    def code(self, i: int) -> bytes:
        return self.ids[self.at[i] : self.at[i] + self.n[i]].tobytes()


def _load(path: str):
    """The tokenizer, the words seen so far and which ids end a sentence; kept by the worker from task to task."""
    if _WORKER.get("path") != path:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
        closes = ends.copy()
        for token, i in tokenizer.get_vocab().items():
            ends[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?")
            closes[i] = token.endswith("</w>")
        _WORKER.update(path=path, tokenizer=tokenizer, words=Known(), ends=ends, closes=closes)
    return _WORKER["tokenizer"], _WORKER["words"], _WORKER["ends"]


def _hashes(words: list[str]) -> np.ndarray:
    """The words' hashes, as a block has them; no word has a space or line break, or is empty."""
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Block(0, data, np.array([0, len(data)]), PARTS, AS_IS).words


def _codes(new: list[str], tokenizer, known: Known, closes: np.ndarray) -> list[bytes]:
    """The ids of new words.

    A Latin word is its letters and the marks after them, which have ids of their own: letters (of ASCII in lower case)
    and marks are encoded once, letters many words in a text. Other words are encoded one by one."""
    parts, plain, other = [], set(), set()
    for w in new:
        core, tail = w.rstrip(MARKS), ""
        if core.isalpha() and (core.isascii() or max(core) <= LATIN and "\u0130" not in core):
            tail = w[len(core) :]
            core = core.lower() if core.isascii() else core
            plain.add(core)
            if tail:
                other.add(tail)
        else:
            core = w
            other.add(w)
        parts.append((core, tail))
    words: dict[str, bytes] = {}
    letters = sorted(plain)
    if letters:
        at, seen = known.find(_hashes(letters))
        words.update((letters[i], known.code(at[i])) for i in np.flatnonzero(seen))
        letters = [letters[i] for i in np.flatnonzero(~seen)]
    single = sorted(other - plain)
    groups = [letters[i : i + JOINED] for i in range(0, len(letters), JOINED)]
    for group, e in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, np.uint32)
        stops = np.flatnonzero(closes[ids]) + 1
        if len(stops) != len(group):
            single += group
            continue
        data, at = ids.tobytes(), 0
        for c, to in zip(group, (4 * stops).tolist(), strict=True):
            words[c], at = data[at:to], to
    for w, e in zip(single, tokenizer.encode_batch_fast(single, add_special_tokens=False), strict=True):
        words[w] = array("I", e.ids).tobytes()
    if letters:
        known.add(_hashes(letters), [words[w] for w in letters])
    return [words[core] + words[tail] if tail else words[core] for core, tail in parts]


def encode(block: Block, path: str) -> list[np.ndarray]:
    """The ids of each of the block's texts."""
    tokenizer, known, _ = _load(path)
    if len(known.keys) > REMEMBERED or known.used > REMEMBERED_IDS:
        _WORKER["words"] = known = Known()
    keys, first, row = np.unique(block.words, return_index=True, return_inverse=True)
    at, seen = known.find(keys)
    if not seen.all():
        new = first[~seen]
        data = block.data.tobytes()
        spelled = [data[s:e].decode() for s, e in zip(block.starts[new].tolist(), block.ends[new].tolist(), strict=True)]
        codes = _codes(spelled, tokenizer, known, _WORKER["closes"])
        at, seen_now = known.find(keys[~seen])
        known.add(keys[~seen][~seen_now], [c for c, had in zip(codes, seen_now.tolist(), strict=True) if not had])
        at, _ = known.find(keys)
    n = known.n[at][row].astype(np.int64)
    stops = np.r_[0, np.cumsum(n)]
    ids = known.ids[np.arange(stops[-1]) + np.repeat(known.at[at][row] - stops[:-1], n)] if len(keys) else known.ids[:0]
    edges = stops[block.bounds].tolist()
    return [ids[lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


def _pieces(docs: list[tuple[int | None, np.ndarray, int, int]], ends: np.ndarray, size: int, last: bool) -> tuple[list[list[tuple]], list]:
    """Windows over the documents (id, ids, start, whole length), each a list of pieces; and what is left for later."""
    lengths = np.array([len(d[1]) for d in docs])
    offsets = np.r_[0, np.cumsum(lengths)]
    ids = np.concatenate([d[1] for d in docs])
    cost = np.full(len(ids) + 1, np.inf)
    cost[np.flatnonzero(ends[np.minimum(ids, len(ends) - 1)]) + 1] = SENTENCE_COST
    cost[offsets] = 0
    stops = np.flatnonzero(np.isfinite(cost))
    gaps = np.diff(stops)
    extra = np.concatenate([np.arange(a + STRIDE, a + g, STRIDE) for a, g in zip(stops[:-1][gaps > STRIDE], gaps[gaps > STRIDE], strict=True)] or [stops[:0]])
    cost[extra] = BREAK_COST
    bounds = np.flatnonzero(np.isfinite(cost))
    windows = [int(bounds[j]) for j in cuts(bounds, cost[bounds], size)]
    if not last:
        windows = windows[:-1]
    out, begin, doc = [], 0, 0
    for end in windows:
        row = []
        while begin < end:
            while offsets[doc + 1] <= begin:
                doc += 1
            to = min(end, int(offsets[doc + 1]))
            lo = begin - int(offsets[doc])
            name, own, start, whole = docs[doc]
            row.append((name, start + lo, own[lo : lo + to - begin], whole))
            begin = to
        out.append(row)
    left = []
    for d in range(doc, len(docs)):
        lo = max(0, begin - int(offsets[d]))
        if lo < lengths[d]:
            name, own, start, whole = docs[d]
            left.append((name, own[lo:], start + lo, whole))
    return out, left


SCHEMA = "id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, size: int, end_id: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        held, n = [], 0
        closing = np.array([end_id], np.uint32)
        for batch in _then_none(batches):
            if batch is not None:
                names = batch.column("id").to_pylist()
                for block in text_blocks(batch, separators=PARTS, fold=AS_IS):
                    for name, ids in zip(names[block.first :], encode(block, path)):
                        held.append((name, np.r_[ids, closing], 0, len(ids) + 1))
                        n += len(ids) + 1
                    if n >= BATCH_TOKENS:
                        windows, held = _pieces(held, _load(path)[2], size, False)
                        n = sum(len(d[1]) for d in held)
                        yield _rows(windows, sequence)
                        sequence += len(windows)
            elif held:
                windows, held = _pieces(held, _load(path)[2], size, True)
                yield _rows(windows, sequence)

    return go


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _rows(windows: list[list[tuple]], sequence: int) -> pa.RecordBatch:
    rows = []
    for i, window in enumerate(windows):
        offset = 0
        for name, start, ids, whole in window:
            rows.append((name, start, len(ids), ids.tobytes(), whole, sequence + i, offset))
            offset += len(ids)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = ["id", "start", "length", "token_ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document's ids, then end_id, into sequences of at most size tokens, in the order of the input.

    Each partition of the input is a stream of its own, packed without a shuffle: a dynamic program over the ends of
    documents (free), sentences and, within a long sentence, every 64th token (dearer) finds the windows with
    the least padding plus cost of cuts, through a monotone queue, in linear time. Tokens are packed a bounded number at
    a time; the last window stays open and goes on to the next lot. Every id lies in one piece. Null text is empty: its
    only id is end_id. Returns a row for each piece: id, start (ids of its document before it), length, token_ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_pack(tokenizer, size, end_id), SCHEMA).withColumnRenamed("id", id_col)
