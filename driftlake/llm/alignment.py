"""Alignment of two tokenizers over the same bytes, and how many documents link each pair of their ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship, write_shared
from driftlake.llm.words import BYTE_BASE, run_hashes, tidy

#: Bytes of texts aligned at once (a longer text is aligned alone), hashed at once, and of new chunks encoded as one text.
BLOCK_BYTES, HASH_BYTES, LOT_BYTES = 1 << 19, 1 << 20, 1 << 15
#: Chunks, and bytes of their groups' text, that a worker remembers, about.
REMEMBERED, REMEMBERED_BYTES = 400_000, 32 << 20
#: Bytes of groups' text in a batch that leaves Python (a longer document has one of its own).
OUT_BYTES = 4 << 20
#: Links of a group above which equal ids are counted before they are paired.
WIDE = 4096
#: Distinct irregular pairs counted in a task before they are handed on, and pairs whose counts every task holds; the others
#: meet the documents by a join.
PENDING, HELD = 1 << 20, 1 << 20
#: Tasks that sum vectors of counts.
SUMMERS = 32
_WORKER: dict = {}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: Last bytes of the white space of three UTF-8 bytes (U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000); other
#: characters that end so after the same first byte only make longer chunks.
_LAST = np.zeros(256, bool)
_LAST[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True


def _byte_level() -> dict[str, int]:
    """The byte of each character that stands for one in byte-level vocabularies: printable ones stand for themselves, the others
    follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes of ids, and where each ends."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)], ends


def byte_bpe(path: str):
    """A byte-level BPE tokenizer that parts texts by its usual pattern, and its ids' bytes."""
    import json

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    how = json.loads(t.to_str()).get("pre_tokenizer") or {}
    if how.get("type") != "ByteLevel" or not how.get("use_regex", True) or how.get("add_prefix_space"):
        raise ValueError(f"{path} isn't a byte-level BPE that parts texts by its pattern")
    t.encode_special_tokens = True
    known, of = t.get_vocab(), _byte_level()
    tokens = [b""] * (max(known.values()) + 1)
    for token, i in known.items():
        tokens[i] = bytes(of[c] for c in token)
    return t, Bytes(tokens), tokens


def piece_bpe(path: str):
    """A sentence-piece tokenizer none of whose pieces has a space or line break after another character, and its ids' bytes."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        spelled = bytes([int(piece[3:5], 16)]) if p.is_byte(i) else piece.replace("▁", " ").encode()
        if len(spelled) > 1 and (b" " in spelled.lstrip(b" ") or b"\n" in spelled):
            raise ValueError(f"{path} has a piece that goes on after a space or line break: {piece!r}")
        tokens.append(spelled)
    return p, Bytes(tokens), tokens


def identity_map(a: list[bytes], b: list[bytes], is_byte: list[bool]) -> np.ndarray:
    """For each id of A the id of B that has the same bytes (of several a piece, not a lone byte; then the smallest), or -1."""
    of: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (is_byte[i], i)):
        if b[i]:
            of.setdefault(b[i], i)
    return np.array([of.get(t, -1) for t in a], np.int64)


class Chunks:
    """What a worker knows of chunks, by their hash: groups as text, numbers of ids and groups, and linked pairs."""

    def __init__(self):
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.groups: list[bytes] = []
        self.sizes = np.zeros((0, 3), np.int64)
        self.good = np.zeros(0, bool)
        self.first = np.zeros(1, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return self.at[i] if len(self.keys) else np.zeros(len(keys), np.int64), self.keys[i] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray, found: list[tuple]) -> None:
        n = len(self.groups)
        order = np.argsort(keys)
        to = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, to, keys[order])
        self.at = np.insert(self.at, to, n + order)
        self.groups += [f[0] for f in found]
        self.bytes += sum(len(f[0]) for f in found)
        self.sizes = np.concatenate([self.sizes, np.array([f[1:4] for f in found], np.int64).reshape(-1, 3)])
        self.good = np.concatenate([self.good, np.array([f[6] for f in found], bool)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(f[4]) for f in found])])
        self.pairs = np.concatenate([self.pairs, *[f[4] for f in found]])
        self.times = np.concatenate([self.times, *[f[5] for f in found]])


def _load(a_path: str, b_path: str) -> dict:
    """Both tokenizers and what is known of chunks; kept by the worker from task to task."""
    if _WORKER.get("paths") != (a_path, b_path):
        a, a_bytes, a_tokens = byte_bpe(a_path)
        b, b_bytes, b_tokens = piece_bpe(b_path)
        _WORKER.update(paths=(a_path, b_path), a=a, b=b, a_bytes=a_bytes, b_bytes=b_bytes, n_b=len(b_tokens), chunks=Chunks())
        for side, n in (("a", len(a_tokens)), ("b", len(b_tokens))):
            ends = (b",", b"|") if side == "a" else (b",", b";")
            _WORKER[f"{side}_text"] = [str(i).encode() + e for e in ends for i in range(n)]
        _WORKER["size_a"], _WORKER["size_b"] = len(a_tokens), len(b_tokens)
    return _WORKER


def _links(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, n: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of ids (as one number), how often each, and their group (ascending): every id of A with every one of B in a group."""
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    fa, fb = np.cumsum(na) - na, np.cumsum(nb) - nb
    wide = na * nb > WIDE
    size = np.where(wide, 0, na * nb)
    group = np.repeat(np.arange(n), size)
    within = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    pairs = a[fa[group] + within // nb[group]] * n_b + b[fb[group] + within % nb[group]]
    times = np.ones(len(pairs), np.int64)
    for g in np.flatnonzero(wide):
        ka, ca = np.unique(a[fa[g] : fa[g] + na[g]], return_counts=True)
        kb, cb = np.unique(b[fb[g] : fb[g] + nb[g]], return_counts=True)
        at = np.searchsorted(group, g)
        more = (ka[:, None] * n_b + kb).ravel()
        pairs, times = np.insert(pairs, at, more), np.insert(times, at, (ca[:, None] * cb).ravel())
        group = np.insert(group, at, np.full(len(more), g))
    return pairs, times, group


def _aligned(tools: dict, text: bytes, ends: np.ndarray) -> list[tuple] | None:
    """Each chunk of a text that begins with a space; None where ids don't spell the text or a chunk's end isn't one of both."""
    spelled = text.decode()
    a = np.array(tools["a"].encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.int64)
    b = np.array(tools["b"].encode(spelled[1:]), np.int64)
    data = np.frombuffer(text, np.uint8)
    (by_a, ea), (by_b, eb) = tools["a_bytes"].spell(a), tools["b_bytes"].spell(b)
    if not (np.array_equal(by_a, data) and np.array_equal(by_b, data)):
        return None
    both = np.intersect1d(ea, eb)
    last = np.searchsorted(both, ends)
    if not np.array_equal(both[np.minimum(last, len(both) - 1)], ends):
        return None
    ga, gb, n = np.searchsorted(both, ea), np.searchsorted(both, eb), len(both)
    side = np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
    order = np.argsort(2 * np.r_[ga, gb] + side, kind="stable")
    ends_a, ends_b = np.r_[ga[1:] != ga[:-1], True], np.r_[gb[1:] != gb[:-1], True]
    text_a, text_b = tools["a_text"], tools["b_text"]
    parts = [text_a[i] for i in (a + ends_a * tools["size_a"]).tolist()] + [text_b[i] for i in (b + ends_b * tools["size_b"]).tolist()]
    parts = [parts[i] for i in order.tolist()]
    pairs, times, group = _links(a, b, ga, gb, n, tools["size_b"])
    stop = last + 1
    cut_a, cut_b, cut_p = np.searchsorted(ga, stop), np.searchsorted(gb, stop), np.searchsorted(group, stop)
    out, was = [], (0, 0, 0, 0)
    for g, i, j, p in zip(stop.tolist(), cut_a.tolist(), cut_b.tolist(), cut_p.tolist(), strict=True):
        out.append((b"".join(parts[was[1] + was[2] : i + j])[:-1], i - was[1], j - was[2], g - was[0], pairs[was[3] : p], times[was[3] : p], True))
        was = (g, i, j, p)
    return out


_NONE = (b"", 0, 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64), False)


def _learned(tools: dict, chunks: list[bytes], opens: np.ndarray, closes: np.ndarray) -> list[tuple]:
    """What is to be known of new chunks: many are encoded as one text, as no id goes across their edges."""
    out: list[tuple] = [_NONE] * len(chunks)

    def alone(i: int) -> tuple:
        head = b" a" if opens[i] else b""
        found = _aligned(tools, head + chunks[i], np.r_[[2] if head else [], len(head) + len(chunks[i])].astype(np.int64))
        return found[-1] if found else _NONE

    lot, size = [], 0
    for i in [*range(len(chunks)), None]:
        if lot and (i is None or size > LOT_BYTES):
            ends = 2 + np.cumsum([0, *[len(chunks[j]) for j in lot]])
            found = _aligned(tools, b" a" + b"".join(chunks[j] for j in lot), ends)
            for j, f in zip(lot, found[1:] if found else map(alone, lot), strict=True):
                out[j] = f
            lot, size = [], 0
        if i is not None and opens[i] and closes[i]:
            lot.append(i)
            size += len(chunks[i])
        elif i is not None:
            out[i] = alone(i)
    return out


def _cuts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where chunks begin in documents that begin at starts (each with a space), and which begin and end beside no other white space.

    A chunk begins at a single space or line break between characters that aren't white space: there both tokenizers begin anew."""
    n = len(data)
    far = np.r_[data, 0, 0, 0]
    high = (far[:n] >= 0xE1) & (far[:n] <= 0xE3)
    opens = _SPACE[data] | (far[:n] == 0xC2) & ((far[1 : n + 1] == 0x85) | (far[1 : n + 1] == 0xA0)) | high & _LAST[far[2 : n + 2]]
    back = np.r_[np.zeros(2, np.uint8), data]
    closes = _SPACE[data] | (back[1 : n + 1] == 0xC2) & ((data == 0x85) | (data == 0xA0)) | (back[:n] >= 0xE1) & (back[:n] <= 0xE3) & _LAST[data]
    after, before = np.r_[opens[1:], True], np.r_[True, closes[:-1]]
    cut = ((data == 32) | (data == 10)) & ~before & ~after
    stops = np.r_[starts[1:], n]
    cut[stops - 1] = False
    cut[starts] = True
    at = np.flatnonzero(cut)
    return at, ~after[at], ~closes[np.r_[at[1:], n] - 1]


def _block(tools: dict, texts: list[bytes]) -> Iterator[tuple]:
    """Of each text (beginning with a space): groups as text, numbers of ids A and B, groups and links, and its pairs, ascending, with how often."""
    known: Chunks = tools["chunks"]
    if len(known.groups) > REMEMBERED or known.bytes > REMEMBERED_BYTES:
        tools["chunks"] = known = Chunks()
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    at, opens, closes = _cuts(data, starts)
    ends = np.r_[at[1:], len(data)]
    hashes = np.empty(len(at), np.uint64)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, at[lo] + HASH_BYTES, "right")))
        part = data[at[lo] : ends[hi - 1]].astype(np.uint64) + np.uint64(1)
        hashes[lo:hi] = run_hashes(part, at[lo:hi] - at[lo], ends[lo:hi] - at[lo], BYTE_BASE)
        lo = hi
    # a text that begins with white space begins in another way than the same bytes elsewhere
    hashes[~opens] ^= np.uint64(0x5851F42D4C957F2D)
    keys, first, row = np.unique(hashes, return_index=True, return_inverse=True)
    _, seen = known.find(keys)
    if not seen.all():
        new = first[~seen]
        whole = data.tobytes()
        spelled = [whole[s:e] for s, e in zip(at[new].tolist(), ends[new].tolist(), strict=True)]
        known.add(keys[~seen], _learned(tools, spelled, opens[new], closes[new]))
    code = known.find(keys)[0][row]
    doc = np.searchsorted(starts, at, "right") - 1
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    total = np.zeros((len(code) + 1, 3), np.int64)
    np.cumsum(known.sizes[code], axis=0, out=total[1:])
    sizes = total[bounds[1:]] - total[bounds[:-1]]
    good = np.bincount(doc[~known.good[code]], minlength=len(texts)) == 0
    # pairs of each document: of its distinct chunks, then together
    span = len(known.groups)
    held, count = np.unique(doc * span + code, return_counts=True)
    of, chunk = held // span, held % span
    n = known.first[chunk + 1] - known.first[chunk]
    place = np.repeat(known.first[chunk] - np.cumsum(n) + n, n) + np.arange(n.sum())
    shift = np.int64(tools["size_a"] * tools["size_b"]).item().bit_length()
    key = np.repeat(of, n) << shift | known.pairs[place]
    times = known.times[place] * np.repeat(count, n)
    order = np.argsort(key, kind="stable")
    key, times = key[order], np.r_[0, np.cumsum(times[order])]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = times[np.r_[head[1:], len(key)]] - times[head]
    key = key[head]
    edge = np.searchsorted(key, np.arange(len(texts) + 1) << shift)
    links = np.r_[0, np.cumsum(times)][edge]
    codes = code.tolist()
    for i in range(len(texts)):
        if not good[i]:
            yield b"", 0, 0, 0, 0, key[:0], times[:0]
            continue
        lo, hi = edge[i], edge[i + 1]
        groups = b";".join([known.groups[c] for c in codes[bounds[i] : bounds[i + 1]]])
        yield groups, *sizes[i].tolist(), int(links[i + 1] - links[i]), key[lo:hi] & ((1 << shift) - 1), times[lo:hi]


_FIELDS = ["row", "groups", "n_a", "n_b", "n_groups", "n_links", "pairs", "times"]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    stops = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(parts) if parts else np.zeros(0), kind))


def _go(a_path: str, b_path: str, schema: pa.Schema):
    def batch_of(ids: list, rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        arrays = [pa.array(ids, schema.field(0).type), pa.array([g.decode() for g in cols[0]], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:5]]]
        return pa.RecordBatch.from_arrays([*arrays, _lists(list(cols[5]), schema.field("pairs").type.value_type), _lists(list(cols[6]), pa.int64())], schema=schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _load(a_path, b_path)
        empty = (b"", 0, 0, 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            lot: list[tuple[int, bytes]] = []
            rows, names, size = [], [], 0

            def done(lot=lot) -> list[tuple]:
                found = _block(tools, [t for _, t in lot if t]) if any(t for _, t in lot) else iter(())
                return [(ids[i], next(found) if t else empty) for i, t in lot]

            held = 0
            for i in range(len(ids)):
                t = texts[i].as_py()
                spelled = b" " + t.encode() if t else b""
                if lot and held + len(spelled) > BLOCK_BYTES:
                    todo, lot, held = done(lot), [], 0
                    for name, row in todo:
                        names.append(name)
                        rows.append(row)
                        size += len(row[0])
                        if size > OUT_BYTES:
                            yield batch_of(names, rows)
                            rows, names, size = [], [], 0
                lot.append((i, spelled))
                held += len(spelled)
            for name, row in done(lot):
                names.append(name)
                rows.append(row)
            if rows:
                yield batch_of(names, rows)
            tidy()

    return go


def _sizes(a_path: str, b_path: str) -> tuple[np.ndarray, int]:
    """The identity map, and how many ids B has."""
    _, _, a = byte_bpe(a_path)
    p, _, b = piece_bpe(b_path)
    return identity_map(a, b, [p.is_byte(i) for i in range(len(b))]), len(b)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's groups: the ids of A and of B between two byte offsets at which tokens of both end.

    A encodes a space and the text, B the text (and adds the space itself). Returns id_col, groups (`a1,a2|b1;a3|b2,b3`, ids
    in order), n_a, n_b, n_groups, n_links (pairs of an id of A and one of B that share a group, each time they do), and the
    distinct pairs (id of A times B's number of ids, plus id of B; ascending) with their times. Texts that are null or empty,
    or that the ids don't spell byte for byte, have no groups, zeros and empty arrays. Rows that repeat, or share an id, are
    rows of their own; an empty table gives none; other columns aren't carried.

    A text is cut at single spaces and line breaks, where both tokenizers begin anew whatever stands before, and each distinct
    chunk is encoded once a block, or not at all if the worker knows it.
    """
    spark = docs.sparkSession
    ship(spark)
    same, n_b = _sizes(a_path, b_path)
    kind = "int" if len(same) * n_b < 1 << 31 else "long"
    id_type = docs.schema[id_col].dataType.simpleString()
    out = f"row {id_type}, groups string, n_a long, n_b long, n_groups long, n_links long, pairs array<{kind}>, times array<long>"
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    types = [pa.string(), *[pa.int64()] * 4, pa.list_(pa.int32() if kind == "int" else pa.int64()), pa.list_(pa.int64())]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([pa.field("row", to_arrow_type(docs.schema[id_col].dataType)), *[pa.field(n, t) for n, t in zip(_FIELDS[1:], types, strict=True)]])
    return rows.mapInArrow(_go(a_path, b_path, schema), out).withColumnRenamed("row", id_col)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy())


def _count(same: np.ndarray, n_b: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), np.int64)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        n = 0

        def rows(keys: np.ndarray, counts: np.ndarray, vector: np.ndarray | None = None) -> pa.RecordBatch:
            mine = [] if vector is None else [vector.tobytes()]
            k = len(mine)
            sums = pa.array([None] * len(keys) + mine, pa.binary())
            none = [pa.nulls(k, pa.int64())] if k else []
            cols = [pa.concat_arrays([pa.array(x, pa.int64()), *none]) for x in (keys, counts)]
            return pa.RecordBatch.from_arrays([*cols, sums], ["pair", "n", "vector"])

        def summed() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *waiting])
            weight = np.concatenate([counts, np.ones(len(every) - len(keys), np.int64)])
            order = np.argsort(every, kind="stable")
            every, total = every[order], np.r_[0, np.cumsum(weight[order])]
            head = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
            return every[head], total[np.r_[head[1:], len(every)]] - total[head]

        for batch in batches:
            pairs, _ = _flat(batch, "pairs")
            a, b = pairs // n_b, pairs % n_b
            regular = same[a] == b
            vector += np.bincount(a[regular], minlength=len(same))
            waiting.append(pairs[~regular])
            n += len(waiting[-1])
            if n > PENDING:
                keys, counts = summed()
                waiting, n = [], 0
                if len(keys) > PENDING:
                    yield rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        keys, counts = summed()
        yield rows(keys, counts, vector if vector.any() else None)

    return go


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for v in batch.column(0):
            one = np.frombuffer(v.as_py(), np.int64)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["vector"])


def count_pairs(aligned: DataFrame, a_path: str, b_path: str) -> tuple[np.ndarray, DataFrame]:
    """How many rows of align()'s result hold each pair.

    Pairs of an id of A with the id of B of the same bytes are counted in vectors as long as A's vocabulary, which are summed by
    a bounded number of tasks: the vector. Only the others, summed in each task, are shuffled as pairs: a table (pair, n)."""
    same, n_b = _sizes(a_path, b_path)
    parts = write_shared(aligned.select("pairs").mapInArrow(_count(same, n_b), "pair long, n long, vector binary"), "pair_parts")
    vectors = parts.where("vector is not null").select("vector").repartition(SUMMERS).mapInArrow(_sum_vectors, "vector binary").toArrow()
    vector = np.zeros(len(same), np.int64)
    for v in vectors["vector"]:
        vector += np.frombuffer(v.as_py(), np.int64)
    irregular = parts.where("vector is null").groupBy("pair").agg(F.sum("n").alias("n"))
    return vector, write_shared(irregular, "pairs")


def _common(pairs: DataFrame) -> tuple[DataFrame, int, int]:
    """The commonest pairs, HELD at most, with the least count among them and how many pairs there are."""
    eighth = F.floor(F.log2("n") * 8)
    sizes = pairs.groupBy(eighth.alias("e")).agg(F.count("*").alias("k"), F.min("n").alias("least")).collect()
    taken, least = 0, 1 << 62
    for r in sorted(sizes, key=lambda r: -r["e"]):
        if taken + r["k"] > HELD:
            break
        taken, least = taken + r["k"], r["least"]
    return pairs.where(F.col("n") >= least), least, sum(r["k"] for r in sizes) - taken


def _weigh(shared, n_b: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, vector, best, keys, counts = shared.value
        for batch in batches:
            (pairs, sizes), (times, _) = _flat(batch, "pairs"), _flat(batch, "times")
            a, b = pairs // n_b, pairs % n_b
            regular = same[a] == b
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            held = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            n = np.where(regular, vector[a], np.where(held, counts[at] if len(keys) else 0, 0))
            stops = np.r_[0, np.cumsum(sizes)]
            sums = [np.diff(np.r_[0, np.cumsum(x)][stops]) for x in (times * n, np.where((regular | held) & (n == best[a]), times, 0))]
            rare = ~(regular | held)
            off = np.r_[0, np.cumsum(rare)][stops].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x[rare], pa.int64())) for x in (pairs, times)]
            kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] not in ("pairs", "times")]
            names = [x for x in batch.schema.names if x not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(x, pa.int64()) for x in sums], *lists], [*names, "count_sum", "n_best", "rare", "rare_times"])

    return go


def weigh(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """align()'s rows without their pairs, with count_sum and n_best: over the row's links, the sum of their pairs' counts, and
    how many have a count that no pair of the same id of A exceeds. A pair's count is the number of rows that hold it.

    aligned is read three times, so give a written table. The commonest pairs' counts (HELD at most) and two vectors as long as
    A's vocabulary are broadcast; documents meet the counts of the other pairs by a join."""
    spark = aligned.sparkSession
    ship(spark)
    same, n_b = _sizes(a_path, b_path)
    vector, pairs = count_pairs(aligned, a_path, b_path)
    best = vector.copy()
    top = pairs.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("n")).toArrow()
    np.maximum.at(best, top["a"].to_numpy(), top["n"].to_numpy())
    held, least, left = _common(pairs)
    table = held.toArrow()
    keys, counts = table["pair"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((same, vector, best, keys[order], counts[order]))
    del top, table, keys, counts, order
    tidy()
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    names = [f.name for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join([*rest, "count_sum long, n_best long, rare array<long>, rare_times array<long>"])
    if not left:
        return aligned.mapInArrow(_weigh(shared, n_b), schema).drop("rare", "rare_times")
    numbered = write_shared(aligned.mapInArrow(_weigh(shared, n_b), schema).withColumn("__row", F.monotonically_increasing_id()), "weighed")
    tops = spark.createDataFrame([(int(a), int(best[a])) for a in np.flatnonzero(best)], "a long, best long")
    others = pairs.where(F.col("n") < least).join(tops, F.expr(f"pair div {n_b}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
    each = numbered.select("__row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r")).select("__row", F.col("r.rare").alias("pair"), F.col("r.rare_times").alias("times"))
    more = each.join(others, "pair").groupBy("__row").agg(F.sum(F.col("times") * F.col("n")).alias("__sum"), F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("__best"))
    both = numbered.join(more, "__row", "left")
    plus = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return both.select(*names, plus("count_sum", "__sum"), plus("n_best", "__best"))
