"""From raw documents to packed training sequences: five stages, each written and read again as the next one's input."""

from __future__ import annotations

from driftlake.llm import language_id, pii
from driftlake.llm.decontamination import benchmark_overlap
from driftlake.llm.jaccard_join import jaccard_classes
from driftlake.llm.packing import pack
from driftlake.llm.queries import tokenizer_path
from driftlake.llm.scratch import may_be_among, without_ids, write_shared
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A text whose best language has less than this share of the odds is of no known language.
LEAST_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of no known language: `und` (null, or without a letter), or a score under LEAST_SCORE.

    A null lang is filled with the predicted one. Repeated rows share their fate; no rows give none."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    told = docs.withColumn("__told", language_id.language_of(docs, model)).where(f"__told.lang <> 'und' and __told.score >= {LEAST_SCORE}")
    return told.withColumn("lang", F.coalesce("lang", "__told.lang")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 the one of smallest id stays, once.

    Rows of null id and texts without words are linked with nothing and stay. Rows that repeat an id and its text stay once;
    two texts of one id share the fate of their id."""
    classes = jaccard_classes(docs)
    kept = without_ids(docs, classes.where("component_id <> doc_id").select("doc_id"))
    again = write_shared(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    once = kept.where(may_be_among(again, F.col("doc_id"))).join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return without_ids(kept, again).unionByName(once)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half or more of a benchmark item's words in tiles go; null and empty texts and null ids stay."""
    return without_ids(docs, benchmark_overlap(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is put out by its kind in brackets; n_chars follows (null for a null text). Every row stays."""
    clean = pii.redact(pii.find(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row for each piece; a null text is one piece, of the closing id alone."""
    pieces = pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Language models, tilings and tokenizers are beyond SQL; tests hold run() against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
