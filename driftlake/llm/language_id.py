"""Language identification: known words first, ever shorter character n-grams for the others."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship, write_shared
from driftlake.llm.words import AS_IS, PUNCT, Block, mix, powers, text_blocks, tidy

#: The bounds of the sample of each language that a model is fitted on (about): labelled documents, and characters of them, so
#: many that a table of its words by languages, at six characters a word, has FIT_CELLS numbers at most. All its words are kept.
FIT_DOCS, FIT_CELLS, WORD_CHARS = 2000, 1 << 24, 6
#: Characters of the longest n-grams.
LONGEST = 5
#: Words that a document's score counts at most.
EVIDENCE = 30
#: Texts taken apart at once.
ROWS = 1000
_LETTER_BASE = 0x9E3779B97F4A7C15


@dataclass
class Model:
    """Log frequencies by language of words and of n-grams (by n - 1), under sorted hashes."""

    langs: list[str]
    words: np.ndarray
    word_scores: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]


def _logs(keys: np.ndarray, langs: np.ndarray, counts: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(keys, return_inverse=True)
    table = np.zeros((len(known), n_langs))
    np.add.at(table, (at, langs), counts)
    return known, np.log((table + 0.5) / (table.sum(0) + 0.5 * (len(known) + 1))).astype(np.float32)


def _block_of(words: list[str]) -> Block:
    column = pa.array(words, pa.large_string())
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[: len(words) + 1]
    return Block(0, np.frombuffer(data, np.uint8)[: offs[-1]], offs, PUNCT, AS_IS)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", n_docs: int = FIT_DOCS, n_cells: int = FIT_CELLS) -> Model:
    """Fit on about n_docs documents of each language, dealt by the hash of their id (fewer where they are so long, or languages so
    many, that a table of more than n_cells numbers would come of them). All words of the sample, and every language that a row is
    labelled with, are learned.

    Rows of null text or label and repeated rows teach what they hold; an empty table gives a model that knows nothing."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), [])
    most = WORD_CHARS * n_cells / len(langs) ** 2
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, n_docs / r["n"], most / max(1, r["chars"])))])
    sample = rows.where(F.pmod(F.xxhash64(F.col("id")), F.lit(1 << 20)) < F.coalesce(share[F.col("lang")], F.lit(0.0)) * (1 << 20))
    words = sample.select("lang", F.explode(F.split(F.lower("text"), r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")).alias("word")).where("word <> ''")
    counts = write_shared(words.groupBy("lang", "word").count(), "words")
    size = "length(word)"
    each = f"flatten(transform(filter(sequence(1, {LONGEST}), k -> k <= {size}), k -> transform(sequence(1, {size} - k + 1), i -> substr(word, i, k))))"
    grams = counts.select("lang", "count", F.explode(F.expr(each)).alias("word")).groupBy("lang", "word").agg(F.sum("count").alias("count"))
    keys, scores = _logs(*_told_by(counts, langs, lambda names: _block_of(names).words), len(langs))
    spelled, tables = _told_by(grams, langs, _whole_grams), []
    for k in range(1, LONGEST + 1):
        own = spelled[0][0] == k
        tables.append(_logs(spelled[0][1][own], spelled[1][own], spelled[2][own], len(langs)))
    del spelled
    tidy()
    return Model(langs, keys, scores, tables)


def _told_by(counts: DataFrame, langs: list[str], keys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of counts (lang, word, count) the word's keys, the language's number and the count, some rows at a time."""
    table = counts.toArrow()
    parts = []
    for batch in table.to_batches(1 << 16):
        names = batch.column("word").to_pylist()
        parts.append((keys(names), np.searchsorted(langs, batch.column("lang").to_pylist()), batch.column("count").to_numpy()))
    del table
    tidy()
    none = [(keys([]), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    return tuple(np.concatenate(x, axis=-1) for x in zip(*(parts or none), strict=True))


def _whole_grams(names: list[str]) -> np.ndarray:
    """The characters of each n-gram, and its key."""
    letters, starts, ends = _letters(" ".join(names), len(names))
    out = np.zeros((2, len(names)), np.uint64)
    out[0] = ends - starts
    for k in range(1, LONGEST + 1):
        own = np.flatnonzero(out[0] == k)
        out[1, own] = _gram_keys(letters, starts[own], k)
    return out


def _letters(words: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of n words with a space between, and where each word starts and ends."""
    letters = np.frombuffer(words.encode("utf-32-le"), np.uint32).astype(np.uint64)
    spaces = np.flatnonzero(letters == 32)
    return letters, np.r_[0, spaces + 1][:n], np.r_[spaces, len(letters)][:n]


def _places(starts: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of k characters in the words: its word and its first character."""
    sizes = np.maximum(0, ends - starts - k + 1)
    word = np.repeat(np.arange(len(starts)), sizes)
    within = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return word, starts[word] + within


def _gram_keys(letters: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    key = np.zeros(len(start), np.uint64)
    for i, p in enumerate(powers(_LETTER_BASE, k)):
        key += (letters[start + i] + np.uint64(1)) * p
    return mix(key)


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
    return at, known[at] == keys if len(known) else np.zeros(len(keys), bool)


def _word_scores(model: Model, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct words' log frequencies by language, and each word's row of them."""
    _, first, row = np.unique(block.words, return_index=True, return_inverse=True)
    at, known = _find(model.words, block.words[first])
    scores = np.zeros((len(first), len(model.langs)), np.float32)
    scores[known] = model.word_scores[at[known]]
    open_ = np.flatnonzero(~known)
    data = block.data.tobytes()
    spelled = b" ".join(data[s:e] for s, e in zip(block.starts[first[open_]].tolist(), block.ends[first[open_]].tolist(), strict=True))
    letters, starts, ends = _letters(spelled.decode("utf-8", "replace"), len(open_))
    for k in range(LONGEST, 0, -1):
        word, start = _places(starts, ends, k)
        at, hit = _find(model.grams[k - 1][0], _gram_keys(letters, start, k))
        n = np.bincount(word[hit], minlength=len(open_))
        table = model.grams[k - 1][1][at[hit]]
        total = np.stack([np.bincount(word[hit], table[:, j], len(open_)) for j in range(len(model.langs))], 1)
        scores[open_[n > 0]] = total[n > 0] / n[n > 0, None]
        open_, starts, ends = open_[n == 0], starts[n == 0], ends[n == 0]
    return scores, row


def _told(model: Model, text: pa.Array) -> pa.Array:
    """The language and score of each text."""
    letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    lang, score = np.full(len(text), "und", object), np.zeros(len(text))
    lowered = pa.RecordBatch.from_arrays([pc.utf8_lower(text)], ["text"])
    for block in text_blocks(lowered, separators=PUNCT, fold=AS_IS) if model.langs else ():
        scores, row = _word_scores(model, block)
        words = np.diff(block.bounds)
        each = scores[row]
        sums = np.stack([np.bincount(block.doc, each[:, j], block.n_docs) for j in range(len(model.langs))], 1)
        mean = sums / np.maximum(1, words)[:, None] * np.minimum(words, EVIDENCE)[:, None]
        odds = np.exp(mean - mean.max(1, keepdims=True))
        best = mean.argmax(1)
        mine = np.arange(block.first, block.first + block.n_docs)
        told = letters[mine]
        lang[mine[told]] = np.array(model.langs, object)[best[told]]
        score[mine[told]] = (odds.max(1) / odds.sum(1))[told]
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang", "score"])


def language_of(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The predicted language of each row of docs: a struct of lang and score (0 to 1), from the whole text alone.

    A document's score for a language is the mean over its words of the log frequency of the word, or, for a word that
    no language has, the mean log frequency of its longest known n-grams (5 characters down to 1). `und`, with score 0, if
    the text is null or has no letter, or nothing was learned. Ties go to the first language by name. Repeated rows have
    the same answer; an empty table has none; a text of any length is read whole, and only texts go to Python. Words and
    n-grams are held in tables of bounded size, so that the model is broadcast safely.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def told(text: pa.Array) -> pa.Array:
        parts = [_told(shared.value, text.slice(lo, ROWS)) for lo in range(0, len(text), ROWS)]
        return pa.concat_arrays(parts) if parts else _told(shared.value, text)

    # told once a row, also where a filter reads the answer
    return told.asNondeterministic()(docs[text_col].cast("string"))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs, lang_pred and score as language_of has them; a name that docs has already gets `_` after it."""
    names = []
    for name in ("lang_pred", "score"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    told = docs.withColumn("__told", language_of(docs, model, text_col))
    return told.select(*docs.columns, F.col("__told.lang").alias(names[0]), F.col("__told.score").alias(names[1]))


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the documents, by checksum of the id's text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))
