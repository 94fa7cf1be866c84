"""Quality of whole texts: plain rules, and a calibrated logistic regression over hashed words and characters."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftlake.llm.scratch import ship, write_shared
from driftlake.llm.words import AS_IS, BYTE_BASE, WHITE, Block, mix, powers, run_hashes, text_blocks

#: The bound of the fit: labelled rows of each class (about), of which a quarter calibrates.
FIT_ROWS = 2000
#: Buckets of a family of n-grams (a power of 2): words alone and in pairs, and characters in twos, threes and fours.
BITS, WORD_GRAMS, CHAR_GRAMS = 15, (1, 2), (2, 3, 4)
FAMILIES = len(WORD_GRAMS) + len(CHAR_GRAMS)
#: Strength of the penalty on the sum of squared weights, and rounds of the solver at most. A feature is an n-gram's share of its family's, so that weights are large.
PENALTY, ROUNDS = 1e-6, 50
#: Fixed thresholds: fewest words, most words of a hundred in repeated windows of so many words, least probability of quality.
LEAST_WORDS, MOST_REPEATED, WINDOW, KEEP_AT = 20, 30, 8, 0.5
_CHAR_BASE = 0xA0761D6478BD642F
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass
class Model:
    """Weights by bucket, and the line from a margin to the calibrated log odds."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0


def _spelled(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the block's texts, and where each text's begin (and the last one's end)."""
    begins = (block.data & 0xC0) != 0x80
    before = np.r_[0, np.cumsum(begins)]
    letters = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    return letters, before[block.offsets]


def _grams(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each family the n-grams' buckets and documents, in order of the documents."""
    out = []
    shift, base = np.uint64(64 - BITS), 0
    for k in WORD_GRAMS:
        keys, whole = block.grams(k)
        out.append(((mix(keys[whole]) >> shift).astype(np.int64) + base, block.doc[: len(keys)][whole]))
        base += 1 << BITS
    letters, edges = _spelled(block)
    doc = np.repeat(np.arange(block.n_docs), np.diff(edges))
    for k in CHAR_GRAMS:
        n = max(0, len(letters) - k + 1)
        key = np.zeros(n, np.uint64)
        for i, p in enumerate(powers(_CHAR_BASE, k)):
            key += (letters[i : i + n] + np.uint64(1)) * p
        whole = doc[:n] == doc[k - 1 : k - 1 + n]
        out.append(((mix(key[whole]) >> shift).astype(np.int64) + base, doc[:n][whole]))
        base += 1 << BITS
    return out


def _vectors(texts: pa.Array) -> pa.Array:
    """Each text's features as Spark's sparse vectors hold them: every n-gram's share of the n-grams of its family."""
    at, values, ends = [], [], [0]
    for block in text_blocks(pa.RecordBatch.from_arrays([texts], ["text"]), fold=AS_IS):
        own: list[list] = [[] for _ in range(block.n_docs)]
        for bucket, doc in _grams(block):
            edges = np.searchsorted(doc, np.arange(block.n_docs + 1))
            for i in range(block.n_docs):
                b, n = np.unique(bucket[edges[i] : edges[i + 1]], return_counts=True)
                own[i].append((b, n / max(1, n.sum())))
        for parts in own:
            at += [p[0] for p in parts]
            values += [p[1] for p in parts]
            ends.append(ends[-1] + sum(len(p[0]) for p in parts))
    n = len(texts)
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else np.zeros(0), kind)) for x, kind in ((at, pa.int32()), (values, pa.float64()))]
    return pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, FAMILIES << BITS, np.int32)), *lists], ["type", "size", "indices", "values"])


def _margins(block: Block, model: Model) -> np.ndarray:
    total = np.full(block.n_docs, model.intercept)
    for bucket, doc in _grams(block):
        total += np.bincount(doc, model.weights[bucket], block.n_docs) / np.maximum(1, np.bincount(doc, minlength=block.n_docs))
    return total


def _repeats(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key comes twice or more in its document, and whether an equal one of the document comes before it."""
    own = mix(keys ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order] = np.r_[False, same] | np.r_[same, False] if len(keys) else False
    later[order] = np.r_[False, same] if len(keys) else False
    return again, later


def _figures(block: Block) -> list[np.ndarray]:
    """Of each text: words, their characters, symbols, repeated lines, and words in repeated windows."""
    n = block.n_docs
    data, edges = block.data, block.offsets

    def counted(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flags)][edges])

    chars = counted(~WHITE[data] & ((data & 0xC0) != 0x80))
    begins = np.zeros(len(data) + 1, bool)
    begins[edges] = True
    begins[1:] |= data == 10
    starts = np.flatnonzero(begins[:-1])
    ends = np.r_[starts[1:], len(data)]
    of = np.searchsorted(edges, starts, "right") - 1
    ends -= (data[np.maximum(ends, 1) - 1] == 10) & (ends > starts) if len(starts) else 0
    lines = run_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends, BYTE_BASE)
    inside = np.r_[0, np.cumsum(~WHITE[data])]
    worded = inside[ends] > inside[starts]
    _, later = _repeats(of[worded], lines[worded])
    windows, whole = block.grams(WINDOW)
    at = np.flatnonzero(whole)
    again, _ = _repeats(block.doc[at], windows[at])
    cover = np.zeros(len(block.words) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return [np.diff(block.bounds), chars, counted(_SYMBOLS[data]), np.bincount(of[worded][later], minlength=n), np.bincount(block.doc[covered], minlength=n)]


_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RESULT = ", ".join(f"{n}:bigint" for n in _NAMES) + ", score:double"


def _scored(texts: pa.Array, model: Model, figures: bool = True) -> pa.Array:
    out, scores = [[np.zeros(0, np.int64)] for _ in _NAMES], [np.zeros(0)]
    for block in text_blocks(pa.RecordBatch.from_arrays([texts], ["text"]), fold=AS_IS):
        scores.append(_margins(block, model))
        for held, x in zip(out, _figures(block) if figures else (), strict=False):
            held.append(x)
    margin = np.concatenate(scores)
    if not figures:
        return pa.array(margin)
    odds = np.clip(model.slope * margin + model.offset, -700, 700)
    return pa.StructArray.from_arrays([*[pa.array(np.concatenate(x), pa.int64()) for x in out], pa.array(1 / (1 + np.exp(-odds)))], [*_NAMES, "score"])


def _applied(docs: DataFrame, text: Column, model: Model, figures: bool) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{_RESULT}>" if figures else "double")
    def scored(texts: pa.Array) -> pa.Array:
        return _scored(texts, shared.value, figures)

    return scored.asNondeterministic()(text.cast("string"))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, n_rows: int) -> tuple[DataFrame | None, float]:
    """About n_rows labelled texts of each class, dealt by the hash of their id, with weight, so that a class's weights sum to its
    labels, and fold; None where a class has no labels. And the share of good labels (1 without labels)."""
    told = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).alias("good")).where("id is not null and good is not null").distinct()
    sizes = {r["good"]: r["count"] for r in told.groupBy("good").count().collect()}
    n = sum(sizes.values())
    if len(sizes) < 2:
        return None, sizes.get(True, 0) / n if n else 1.0
    share = {g: min(1.0, n_rows / k) for g, k in sizes.items()}
    deal = F.when(F.col("good"), share[True]).otherwise(share[False])
    ids = told.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < deal * (1 << 20))
    ids = ids.select("id", "good", (1 / deal).alias("weight"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).alias("fold"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return texts.join(write_shared(ids, "labelled"), "id").dropDuplicates(["id", "good", "text"]), sizes[True] / n


def _constant(share: float) -> Model:
    p = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.zeros(FAMILIES << BITS, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))


def _failed(told: str, least_words: int, most_repeated: int) -> Column:
    n = F.col(f"{told}.n_words")
    return (n < least_words) | (100 * F.col(f"{told}.n_repeat_words") > most_repeated * n)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", n_rows: int = FIT_ROWS) -> Model:
    """A logistic regression on about n_rows labelled texts of each class (all if there are fewer; label above 0: good), without
    those that fail the plain rules, of which it is never asked.

    Three quarters of them are fitted, each class's weights summing to the same, and a quarter calibrates: Platt's line from the
    margin to the log odds, with his smoothed targets, weighted back to the classes' shares among all labels. A text with two
    labels teaches both; rows of null id, label or text teach nothing; repeated rows teach once. Without labels of both classes
    the model says their share of good ones for every text (1 without any); where the calibrating quarter lacks a class, the
    regression's own odds stand."""
    spark = docs.sparkSession
    ship(spark)
    sample, good = _sample(docs, labels, id_col, text_col, label_col, n_rows)
    if sample is None:
        return _constant(good)
    sample = sample.withColumn("__told", _applied(sample, F.col("text"), _constant(0.5), True)).where(~_failed("__told", LEAST_WORDS, MOST_REPEATED))
    vector = F.arrow_udf("struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")(_vectors)
    rows = sample.select("good", "weight", "fold", "text", F.col("good").cast("double").alias("label"), vector("text").alias("features"))
    schema = StructType.fromJson(rows.schema.jsonValue())
    schema["features"].dataType = VectorUDT()
    rows = write_shared(rows, "features", schema)
    fitted = rows.where("fold > 0")
    sizes = {r["good"]: r["count"] for r in fitted.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return _constant(good)
    even = F.when(F.col("good"), 0.5 / sizes[True]).otherwise(0.5 / sizes[False]) * sum(sizes.values())
    lr = LogisticRegression(regParam=PENALTY, standardization=False, maxIter=ROUNDS, tol=1e-7, weightCol="even").fit(fitted.withColumn("even", even))
    model = Model(lr.coefficients.toArray().astype(np.float32), float(lr.intercept))
    told = write_shared(rows.where("fold = 0").select("good", "weight", _applied(rows, F.col("text"), model, False).alias("margin")), "margins")
    sizes = {r["good"]: r["n"] for r in told.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return model
    sure = F.when(F.col("good"), (sizes[True] + 1) / (sizes[True] + 2)).otherwise(1 / (sizes[False] + 2))
    both = told.select("margin", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("weight") * sure).alias("w")), F.struct(F.lit(0.0).alias("label"), (F.col("weight") * (1 - sure)).alias("w")))).alias("r")).select("margin", "r.*")
    line = LogisticRegression(maxIter=ROUNDS, tol=1e-9, weightCol="w").fit(VectorAssembler(inputCols=["margin"], outputCol="features").transform(both))
    slope = float(line.coefficients[0])
    if slope > 0:
        model.slope, model.offset = slope, float(line.intercept)
    return model


def judge(docs: DataFrame, model: Model, text_col: str = "text", least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, keep_at: float = KEEP_AT) -> DataFrame:
    """All columns of docs with n_words, word_chars (characters in words), n_symbols (of #*$%&|<>), n_dup_lines (lines with a word
    that are equal to an earlier one), n_repeat_words (words in windows of 8 words found twice or more in the text),
    base_failed (fewer than least_words words, or over most_repeated of a hundred words repeated), score (the probability of quality)
    and kept (not failed, and a score of keep_at or more). A name that docs has already gets `_` after it.

    Words are runs of other than white space (space, \\x09 to \\x0D), and texts are read whole. A null text is empty: zeros,
    failed. Repeated rows have the same answers, an empty table none."""
    ship(docs.sparkSession)
    names = []
    for name in (*_NAMES, "base_failed", "score", "kept"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    told = docs.withColumn("__told", _applied(docs, F.col(text_col), model, True))
    failed = _failed("__told", least_words, most_repeated)
    values = [*[F.col(f"__told.{x}") for x in _NAMES], failed, F.col("__told.score"), ~failed & (F.col("__told.score") >= keep_at)]
    return told.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(x) for v, x in zip(values, names, strict=True)])
