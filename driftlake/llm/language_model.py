"""Language-model scoring: context-tree weighting over the bytes of texts, and an additive unigram base."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship, write_shared
from driftlake.llm.words import LOWER, WHITE, Block, signed, text_blocks, tidy

#: Bytes of the longest contexts; bytes of the shortest that root the tree's parts; words and grams whose scores tasks hold,
#: at most.
DEPTH, ROOT, HOT, HOT_GRAMS = 6, 2, 1 << 19, 1 << 21
#: Grams below a root, and how many roots of one length may be too heavy: with more grams than CROWN of that size, roots grow.
UNDER, CROWN = 1 << 17, 2048
#: Documents of a block; counts that a task sums before it sends them.
DOCS, HELD = 256, 1 << 22
SPACE, END = 32, 10
FOLDED = np.where(WHITE, SPACE, LOWER).astype(np.uint8)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def _lengths(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.r_[first, n])


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a block's running texts and their documents: the DEPTH bytes before each place, nearest first, and the byte.

    A text is a space, its words with a space after each, and the end; before it there are zeros. Seven bytes are taken
    from eight by one read at every place."""
    data, offs, n = FOLDED[block.data], block.offsets, len(block.data)
    inside = data != SPACE
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    begins = offs[:-1][offs[:-1] < n]
    keep[begins] = inside[begins]
    counts = np.r_[0, np.cumsum(keep)][offs]
    size = np.diff(counts)
    last = np.diff(offs) > 0
    last[last] = inside[offs[1:][last] - 1]
    size_all = size + last + 1
    stops = 1 + np.cumsum(size_all + DEPTH)
    asked = np.ones(int(stops[-1]) if len(stops) else 1, bool)
    asked[0] = False
    heads = stops - size_all - DEPTH
    asked[(heads[:, None] + np.arange(DEPTH)).ravel()] = False
    flat = np.zeros(len(asked) + 7, np.uint8)
    taken = asked.copy()
    taken[stops - 1] = False
    taken[stops[last] - 2] = False
    flat[: len(asked)][taken] = data[keep]
    flat[heads + DEPTH - 1] = SPACE
    flat[stops - 1] = END
    flat[stops[last] - 2] = SPACE
    windows = np.ndarray((len(asked) - 7,) if len(asked) > 7 else (0,), "<u8", flat, strides=(1,))[asked[7:]]
    return windows & np.uint64(0x00FFFFFFFFFFFF00) | windows >> np.uint64(56), np.repeat(np.arange(block.n_docs), size_all)


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for lo in range(0, batch.num_rows, DOCS):
        for block in text_blocks(batch.slice(lo, DOCS)):
            block.first += lo
            yield block


def _sent(word: bool, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), word)), pa.array(signed(keys)), pa.array(n.astype(np.int64))], ["word", "key", "n"])


class _Grams:
    """Counts of grams, summed again and again: a gram and its count are sorted as one number, counts over 255 go by themselves."""

    def __init__(self):
        self.settled: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def _merge(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        packed = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        parts.clear()
        packed.sort()
        keys = packed >> np.uint64(8)
        first = _runs(keys)
        keys = keys[first]
        packed &= np.uint64(255)
        return keys, np.add.reduceat(packed, first) if len(first) else packed

    def _packed(self, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Put counts by; those that don't fit are sent."""
        if (many := n > 255).any():
            yield _sent(False, keys[many], n[many])
            keys, n = keys[~many], n[~many]
        self.waiting.append(keys << np.uint64(8) | n)
        self.held += len(keys)

    def add(self, packed: np.ndarray) -> Iterator[pa.RecordBatch]:
        """packed: (gram, whether its row trains) of a block."""
        yield from self._packed(*self._merge([packed]))
        if self.held > HELD:
            yield from self._settle()

    def _settle(self) -> Iterator[pa.RecordBatch]:
        merged = self._merge(self.waiting)
        self.held = 0
        yield from self._packed(*merged)
        self.settled += self.waiting
        self.waiting.clear()
        self.held = 0
        if sum(map(len, self.settled)) > 2 * HELD:
            yield self.all()

    def all(self) -> pa.RecordBatch:
        self.settled += self.waiting
        self.waiting.clear()
        return _sent(False, *self._merge(self.settled))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (by hash) and grams with their counts in training rows (0 for those of other rows only), summed in the task."""
    words, found = [], _Grams()

    def summed() -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*words, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        first = _runs(keys)
        words.clear()
        return keys[first], np.add.reduceat(n[order], first)

    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False)
        for block in _blocks(batch):
            learned = train[block.first : block.first + block.n_docs]
            order = np.argsort(block.words)
            keys = block.words[order]
            if len(first := _runs(keys)):
                words.append((keys[first], np.add.reduceat(learned[block.doc[order]].astype(np.int64), first)))
            if sum(len(k) for k, _ in words) > HELD // 4 + 2 * len(words[0][0]) if words else False:
                words.append(summed())
                if len(words[0][0]) > HELD // 2:
                    yield _sent(True, *words.pop())
            packed, doc = grams(block)
            yield from found.add(packed << np.uint64(8) | learned[doc])
    if words:
        yield _sent(True, *summed())
    yield found.all()


@dataclass
class Level:
    """Nodes of one context length: (bits so far, context) in order, zeros and ones seen there, the node each is under."""

    keys: np.ndarray
    a: np.ndarray
    b: np.ndarray
    up: np.ndarray | None = None
    log_w: np.ndarray | None = None
    part: np.ndarray | None = None


_HALVES = np.array([math.lgamma(i + 0.5) for i in range(4096)])
_WHOLES = np.array([math.lgamma(i + 1.0) for i in range(4096)])


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a zeros and b ones."""

    def g(n: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
        out = table[np.minimum(n, len(table) - 1).astype(np.int64)]
        big = n >= len(table)
        x = n[big] + more
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
        return out

    return g(a, _HALVES, 0.5) + g(b, _HALVES, 0.5) - g(a + b, _WHOLES, 1.0) - math.log(math.pi)


def _above(low: Level) -> Level:
    """The nodes whose contexts are a byte shorter; low.up is set."""
    keys = low.keys >> np.uint64(8)
    new = np.r_[True, keys[1:] != keys[:-1]]
    first, low.up = np.flatnonzero(new), np.cumsum(new) - 1
    up = Level(keys[first], np.add.reduceat(low.a, first), np.add.reduceat(low.b, first))
    own, below = _log_kt(up.a, up.b), np.add.reduceat(low.log_w, first)
    up.log_w = np.logaddexp(own, below) - math.log(2)
    up.part = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
    return up


def _part_levels(grams: np.ndarray, n: np.ndarray, bit: int, root: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[Level]]:
    """Of one binary decision of the last byte of each gram (in order): the grams by bits so far and context, their bits and
    leaves, and the levels from DEPTH to root bytes."""
    byte = (grams & np.uint64(255)).astype(np.uint8)
    order = np.argsort(byte >> np.uint8(8 - bit) if bit else np.zeros(len(byte), np.uint8), kind="stable")
    byte = byte[order].astype(np.uint64)
    key = (np.uint64(1 << bit) | byte >> np.uint64(8 - bit)) << np.uint64(8 * DEPTH) | grams[order] >> np.uint64(8)
    one = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
    new = np.r_[True, key[1:] != key[:-1]]
    first, leaf, n = np.flatnonzero(new), np.cumsum(new) - 1, n[order]
    levels = [Level(key[first], np.add.reduceat(np.where(one, 0, n), first), np.add.reduceat(np.where(one, n, 0), first))]
    levels[0].log_w, levels[0].part = _log_kt(levels[0].a, levels[0].b), np.ones(len(first))
    while len(levels) <= DEPTH - root:
        levels.append(_above(levels[-1]))
    return order, one, leaf, levels


def _descend(level: Level, given: np.ndarray, share: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From what each node's parent passes on: what is settled, what share is left, and the chance of a one at the node.

    Nodes where nothing was seen have their parent's chance."""
    kt = (level.b + 0.5) / (level.a + level.b + 1)
    seen = level.a + level.b > 0
    return given + share * level.part * kt, share * (1 - level.part), np.where(seen, given + share * kt, ones)


def _part_columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    grams, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy().astype(float)
    order = np.argsort(grams)
    return grams[order], n[order], table["root"][0].as_py()


def _roots(table: pa.Table) -> pa.Table:
    """The roots of a part of the tree, weighed over all that is below."""
    grams, n, root = _part_columns(table)
    grams, n = grams[n > 0], n[n > 0]
    tops = [_part_levels(grams, n, bit, root)[3][-1] for bit in range(8)] if len(grams) else []
    columns = [np.concatenate([getattr(t, c) for t in tops] or [np.zeros(0)]) for c in ("keys", "a", "b", "log_w")]
    return pa.table([pa.array(np.full(len(columns[0]), root, np.int32)), pa.array(columns[0].astype(np.int64)), *(pa.array(c) for c in columns[1:])], names=["root", "node", "a", "b", "log_w"])


def _joined(above: Level, low: Level, roots: Level) -> Level:
    """The nodes of one length: those above longer ones, and roots; low.up follows them."""
    order = np.argsort(np.r_[above.keys, roots.keys])
    low.up = np.argsort(order)[low.up]
    both = lambda c: np.r_[getattr(above, c), getattr(roots, c)][order]
    return Level(both("keys"), both("a"), both("b"), None, both("log_w"), both("part"))


def _crown(roots: pa.Table) -> list[tuple[np.ndarray, ...]]:
    """Of the contexts above all roots, by length: keys, what is settled, the share left and the chance of a one."""
    if not roots.num_rows:
        return []
    length, node = roots["root"].to_numpy(), roots["node"].to_numpy().view(np.uint64)
    a, b, log_w = (roots[c].to_numpy() for c in ("a", "b", "log_w"))
    levels, low = [], None
    for d in range(int(length.max()), -1, -1):
        mine = np.flatnonzero(length == d)
        mine = mine[np.argsort(node[mine])]
        own = Level(node[mine], a[mine], b[mine], None, log_w[mine], np.ones(len(mine)))
        low = _joined(_above(low), low, own) if low else own
        levels.append((low, np.isin(low.keys, own.keys)))
    out, passed = [], None
    for level, is_root in levels[:0:-1]:
        n = len(level.keys)
        passed = (np.zeros(n), np.ones(n), np.full(n, 0.5)) if passed is None else tuple(x[level.up] for x in passed)
        passed = _descend(level, *passed)
        out.append(tuple(x[~is_root] for x in (level.keys, *passed)))
    return out


def _passed(crown: list[tuple[np.ndarray, ...]], keys: np.ndarray, root: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the crown passes on to nodes of root bytes."""
    given, share, ones = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5)
    for d, (known, *values) in enumerate(crown[:root]):
        want = keys >> np.uint64(8 * (root - d))
        at = np.minimum(np.searchsorted(known, want), len(known) - 1)
        hit = known[at] == want
        for out, x in zip((given, share, ones), values, strict=True):
            out[hit] = x[at[hit]]
    return given, share, ones


def _part_scores(shared):
    """Log10 of the probability of each gram's last byte after its context: at each bit, the deepest node that is known."""

    def go(table: pa.Table) -> pa.Table:
        grams, n, root = _part_columns(table)
        total = np.zeros(len(grams))
        for bit in range(8):
            order, one, leaf, levels = _part_levels(grams, n, bit, root)
            passed = _descend(levels[-1], *_passed(shared.value, levels[-1].keys, root))
            for level in levels[-2::-1]:
                passed = _descend(level, *(x[level.up] for x in passed))
            p = passed[2][leaf]
            total[order] += np.log10(np.where(one, p, 1 - p))
        return pa.table([pa.array(signed(grams)), pa.array(n.astype(np.int64)), pa.array(total)], names=["key", "n", "tree"])

    return go


def _cut(grams: DataFrame, under: int) -> DataFrame:
    """Grams with the length of their root: ROOT bytes, or as many more as leave no more than `under` grams below it.

    A gram starts with the byte next to its own, so that those under one root share their first bytes. Only roots that are too
    heavy come to the driver: of each length at most the number of grams over `under`."""
    first = lambda length: F.shiftrightunsigned("key", 8 * (DEPTH - length + 1))
    root, rest = F.lit(ROOT), grams
    for length in range(ROOT, DEPTH):
        heavy = [r[0] for r in rest.groupBy(first(length).alias("first")).count().where(F.col("count") > under).select("first").collect()]
        if not heavy:
            break
        # what is under a heavy root is under heavy ones of all shorter lengths
        split = first(length).isin(heavy)
        root, rest = root + split.cast("int"), rest.where(split)
    return grams.select(root.alias("root"), "key", "n").withColumn("first", F.expr(f"shiftrightunsigned(key, 8 * ({DEPTH + 1} - root))"))


def score_grams(grams: DataFrame, under: int = UNDER) -> DataFrame:
    """Weigh the tree of all grams (key, n) and score each: key, n, tree (log10).

    Nothing is left out: the tree is cut at roots of ROOT bytes, or of more where over `under` grams share one, so that no part is
    bound to be larger than that. Tasks weigh parts of about twice as many from the leaves up; the driver weighs the nodes
    above the roots, at most CROWN heavy ones of each length; tasks then go down from these."""
    n_grams = grams.count()
    under = max(under, n_grams // CROWN)
    parts = max(8, n_grams // (2 * under))
    cut = _cut(grams, under).select("root", F.pmod(F.xxhash64("root", "first"), F.lit(parts)).alias("part"), "key", "n")
    ship(grams.sparkSession)
    roots = cut.groupBy("root", "part").applyInArrow(lambda t: _roots(t), "root int, node long, a double, b double, log_w double").toArrow()
    crown = grams.sparkSession.sparkContext.broadcast(_crown(roots))
    return cut.groupBy("root", "part").applyInArrow(_part_scores(crown), "key long, n long, tree double")


class Held:
    """Values by key in a table with two places for each hash: later keys go first, and those that find no place aren't held."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.given = (keys, values)
        self.bits = max(4, (2 * len(keys) - 1).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max)
        self.values = np.zeros(1 << self.bits, np.float32)
        at = self._at(keys, 0)
        self.keys[at], self.values[at] = keys, values
        left = self.keys[at] != keys
        keys, values, at = keys[left], values[left], self._at(keys[left], 1)
        free = self.keys[at] == np.iinfo(np.uint64).max
        self.keys[at[free]], self.values[at[free]] = keys[free], values[free]

    def __reduce__(self):
        return Held, self.given

    def _at(self, keys: np.ndarray, way: int) -> np.ndarray:
        mixed = keys * np.uint64((0x9E3779B97F4A7C15, 0xD1342543DE82EF95)[way])
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is held, and its value, 0 for others."""
        at = self._at(keys, 0)
        hit = self.keys[at] == keys
        value = np.where(hit, self.values[at], np.float32(0))
        left = np.flatnonzero(~hit)
        at = self._at(keys[left], 1)
        again = self.keys[at] == keys[left]
        hit[left], value[left] = again, np.where(again, self.values[at], np.float32(0))
        return hit, value


def _apart(first: np.ndarray, doc: np.ndarray, keys: np.ndarray, name: np.ndarray, kind: int) -> pa.RecordBatch:
    """Rows for runs, from first on, of keys of one document that tasks don't hold."""
    return _rows(name[doc[first]], kind, pa.array(signed(keys[first])), _lengths(first, len(keys)), pa.nulls(len(first), pa.float64()))


def _rows(name: np.ndarray, kind: int, key: pa.Array, times: np.ndarray, value: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(np.full(len(name), kind, np.int8)), key, pa.array(times), value], ["doc", "kind", "key", "times", "value"])


#: Kinds of rows about a document: its id (key), tokens (times) and base; its train flag (key), known tokens and tree; then
#: a word, and a gram, that tasks don't hold.
BASE, TREE, WORD, GRAM = range(4)
_SCHEMA = "doc long, kind tinyint, key long, times long, value double"


def _sums(shared_words, shared_grams, unseen: float):
    """Each row's counts and sums over the words and grams that tasks hold; rows for each of the others."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_grams = shared_words.value, shared_grams.value
        for batch in batches:
            n = batch.num_rows
            known, tokens, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((2, n))
            name = batch.column("doc").to_numpy()
            for block in _blocks(batch):
                mine = slice(block.first, block.first + block.n_docs)
                hit, base = hot.find(block.words)
                tokens[mine] = np.diff(block.bounds)
                known[mine] = np.bincount(block.doc, hit & (base > unseen), block.n_docs)
                sums[0, mine] = np.bincount(block.doc, base, block.n_docs)
                cold = np.flatnonzero(~hit)
                order = np.lexsort((block.words[cold], block.doc[cold]))
                words, of = block.words[cold[order]], block.doc[cold[order]]
                if len(cold):
                    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (of[1:] != of[:-1])])
                    yield _apart(first, of, words, name[mine], WORD)
                packed, doc = grams(block)
                packed = packed << np.uint64(8) | doc.astype(np.uint64)
                packed.sort()
                keys = packed >> np.uint64(8)
                first = _runs(keys)
                hit, tree = hot_grams.find(keys[first])
                each = _lengths(first, len(keys))
                sums[1, mine] = np.bincount((packed & np.uint64(255)).astype(np.int64), np.repeat(tree, each), block.n_docs)
                cold = np.repeat(~hit, each)
                if cold.any():
                    packed = packed[cold]
                    yield _apart(_runs(packed), (packed & np.uint64(255)).astype(np.int64), keys[cold], name[mine], GRAM)
            yield _rows(name, BASE, batch.column("id"), tokens, pa.array(sums[0]))
            yield _rows(name, TREE, batch.column("train").cast(pa.int64()), known, pa.array(sums[1]))

    return go


def _commonest(rows: DataFrame, room: int, *columns: str) -> tuple[np.ndarray, ...]:
    """Keys (uint64), counts and columns of the commonest rows, `room` at most and rarest first: as many ranks of counts as fit."""
    rank = F.floor(8 * F.log2(F.col("n") + 1))
    at = 1 << 30
    for r in rows.groupBy(rank.alias("rank")).count().orderBy(F.desc("rank")).collect():
        room -= r["count"]
        if room < 0:
            break
        at = r["rank"]
    held = rows.where(rank >= at).select("key", "n", *columns).toArrow()
    n = held["n"].to_numpy()
    order = np.argsort(n, kind="stable")
    return held["key"].to_numpy().view(np.uint64)[order], n[order], *(held[c].to_numpy()[order] for c in columns)


def score_documents(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """Score whole texts under models learned from the rows for which train holds.

    A text is its words (lower-cased A-Z; runs of characters other than space and \x09-\x0D), then one end. The model
    is a context tree over the bytes of the running text: words are spelled with a space before and after, each byte is eight
    binary decisions, and each decision mixes Krichevsky-Trofimov estimates over contexts of 0 to DEPTH bytes, across words,
    weighted as context-tree weighting weighs them. Its counts come from the whole of all training texts, and every context
    with its next byte is kept. The base is additive (0.1) over whole words. Scores are found once for each distinct context
    with its next byte. Tasks hold the values of the commonest words and contexts, `hot` and `hot_grams` at most; the
    others meet the texts by a join. Texts are read twice: once counted, once scored.

    Null text is empty (only the end); nothing to train on gives every bit a half; an empty table gives no rows; rows that
    repeat are scored each and learned each. Returns id, train, n_tokens, n_known, train_tokens, base_score, score (log10), a
    row for each row of docs.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select(F.xxhash64("id", "train", "text").alias("doc"), "*")
    # tasks have summed what they could: counts go to their reducers as they are
    counted = texts.mapInArrow(_counts, "word boolean, key long, n long").repartition("word", "key").groupBy("word", "key").agg(F.sum("n").alias("n"))
    counted = write_shared(counted, "counts")
    n_docs = texts.where("train").count()
    words = counted.where("word").select("key", "n")
    sizes = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    n_all, n_distinct = sizes[0] + n_docs, sizes[1] + (n_docs > 0)
    bottom = n_all + 0.1 * (n_distinct + 1)
    trees = write_shared(score_grams(counted.where("not word")), "grams")
    keys, n = _commonest(words, hot)
    unseen = math.log10(0.5 / bottom)
    held_words = spark.sparkContext.broadcast(Held(keys, np.log10((n + 0.1) / bottom)))
    keys, _, tree = _commonest(trees, hot_grams, "tree")
    held_grams = spark.sparkContext.broadcast(Held(keys, tree))
    del keys, n, tree
    tidy()
    parts = write_shared(texts.mapInArrow(_sums(held_words, held_grams, unseen), _SCHEMA), "sums")
    base = F.log10((F.col("n") + 0.1) / F.lit(float(bottom)))
    values = words.select(F.lit(WORD).cast("tinyint").alias("kind"), "key", (F.col("n") > 0).cast("long").alias("seen"), base.alias("one"))
    values = values.unionByName(trees.select(F.lit(GRAM).cast("tinyint").alias("kind"), "key", F.lit(0).cast("long").alias("seen"), F.col("tree").alias("one")))
    # the values' keys are distinct: their side is hashed, evenly over the partitions
    others = parts.where(F.col("kind") >= WORD).select("doc", "kind", "key", "times").join(values.hint("shuffle_hash"), ["kind", "key"])
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    others = others.select("doc", "kind", (F.col("times") * F.col("seen")).alias("times"), (F.col("times") * F.col("one")).alias("value"), F.lit(None).cast("long").alias("key"))
    both = parts.where(F.col("kind") < WORD).unionByName(others).groupBy("doc")
    one = both.agg(
        F.max(of(BASE, F.col("key"))).alias("id"),
        F.max(of(TREE, F.col("key"))).alias("train"),
        F.max(of(BASE, F.col("times"))).alias("tokens"),
        F.sum(F.when(F.col("kind").isin(TREE, WORD), F.col("times"))).alias("known"),
        F.sum(F.when(F.col("kind").isin(BASE, WORD), F.col("value"))).alias("base"),
        F.sum(F.when(F.col("kind").isin(TREE, GRAM), F.col("value"))).alias("tree"),
        F.count_if(F.col("kind") == BASE).alias("copies"),
    )
    # rows that are the same have one key: each has its share of the sums
    one = one.select("id", (F.col("train") > 0).alias("train"), "tokens", (F.col("known") / F.col("copies")).cast("long").alias("known"), (F.col("base") / F.col("copies")).alias("base"), (F.col("tree") / F.col("copies")).alias("tree"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    end_known, end_base = int(n_docs > 0), math.log10((n_docs + 0.1) / bottom)
    return one.select(F.col("id").alias(id_col), "train", (F.col("tokens") + 1).alias("n_tokens"), (F.col("known") + end_known).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + end_base).alias("base_score"), F.col("tree").alias("score"))
