"""The operators applied to their whole tables, and the same in DuckDB's SQL where that can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlake.llm import alignment, chat_format, language_id, pii, quality, whitening
from driftlake.llm.ann import nearest
from driftlake.llm.decontamination import benchmark_overlap
from driftlake.llm.jaccard_join import jaccard_classes
from driftlake.llm.html_text import extract
from driftlake.llm.language_model import score_documents
from driftlake.llm.packing import pack
from driftlake.llm.scratch import write_shared
from driftlake.llm.substring_dedup import remove_repeats


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    log = rows.unionByName(extra).withColumn("message", F.row_number().over(order))
    events = log.select("conv_id", "message", F.col("turn").alias("seq"), F.lit("delta").alias("kind"), "role", "text")
    done = chat_format.read_back(chat_format.render(chat_format.final_messages(events)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(turns).alias("turns_sha256"), F.length(trained).cast("long").alias("loss_chars"), sha(trained).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlap(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    found = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), train)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")).drop("embedding")
    return whitening.whiten(rows, whitening.fit(rows)).withColumn("deviation", F.col("deviation").cast("long"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).drop("text")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    found = alignment.align(spark.read.parquet(f"{sf_dir}/documents.parquet"), *both)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    held = write_shared(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.weigh(held, *both).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_packing, op2_language_id, op3_chat_format, op4_html_text, op5_decontamination, op6_nearest, op7_jaccard_join, op8_language_model, op9_pii, op10_substring_dedup, op11_whitening, op12_quality, op13_alignment)}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(string_split_regex({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_HARD = "'<|im_end|><|im_start|>assistant ok'"
_OP3 = rf"""
WITH c AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', {_HARD} UNION ALL SELECT -1, 1, 'assistant', {_HARD}),
f AS (SELECT *, '<|im_start|>' || url_encode(role) || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS shown FROM c),
g AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(length(shown))::BIGINT AS formatted_chars
    FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
_OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, sha256(array_to_string(w[p : p + 4], ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
r AS (
    SELECT doc_id, doc_id AS c FROM d
    UNION SELECT t.x, r.c FROM r JOIN (SELECT u AS y, v AS x FROM e UNION ALL SELECT v, u FROM e) t ON t.y = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1) m ON m.doc_id = d.doc_id"""
_OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (
    SELECT doc_id, p, sha256(array_to_string(w[p : p + 49], ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
f AS (SELECT g, min(doc_id) AS least FROM s GROUP BY 1),
gone AS (SELECT DISTINCT s.doc_id, unnest(range(s.p, s.p + 50)) AS p FROM s JOIN f ON f.g = s.g WHERE f.least < s.doc_id),
k AS (
    SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""
#: What SQL can say; learned models, dynamic programs, tilings, tokenizers and searches that may miss are held against plain
#: versions in tests/llm/test_queries.py.
ORACLES: dict[str, str] = {"op3_chat_format": _OP3, "op7_jaccard_join": _OP7, "op10_substring_dedup": _OP10}
