"""The pipeline's run() against a plain version of its five stages."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftlake.llm.queries import tokenizer_path
from tests.llm.test_queries import PLAIN, SF, WORD, holds, lower, plain_tiling

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The test documents with hard rows: nulls, copies, near copies, repeated rows, junk, a leak, personal data, a long text."""
    at = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    first = docs.where("lang = 'en' and n_chars > 1500").orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()["text"]
    half = item.split()
    some = [r["text"] for r in docs.where("lang = 'en' and n_chars between 300 and 900").orderBy("doc_id").limit(3).collect()]
    more = [
        (90001, None, "en", "s", None),
        (90002, "", "en", "s", 0),
        (90003, "123 !!", None, "s", 6),
        (90004, first["text"], "en", "s", 1),
        (90005, first["text"] + " Tail.", "en", "s", 1),
        (90006, "The and of to in is " + " ".join(half[len(half) // 2 :] + half[: len(half) // 2]) + " that it for was.", "en", "s", 1),
        (90007, some[0][:200] + " mail bo.b@mail.example or +1 (555) 123-4567 now, ip 10.0.0.1 the end of it.", "en", "s", 1),
        (90008, "the and of that it for was on " * 9000 + "end", "en", "s", 1),
        (90009, "the and of that it for was on other words here", "en", "s", 1),
        (90009, "the and of that it for was on other words here", "en", "s", 1),
        (None, "the and of that it for was on rows without id", "en", "s", 1),
    ]
    docs.unionByName(spark.createDataFrame(more, COLUMNS)).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{at}/benchmark.parquet")
    return at


def plain(rows, items):
    """(doc_id, text) that are left before packing, in the order of ids."""
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [(i, t) for i, t in dict.fromkeys(rows) if i is None or find(i) == i]
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in lower(t)).split(" ")
    items = [[w for w in words(t) if w] for t in items if t]
    kept = []
    for i, t in rows:
        text = [w for w in words(t) if w]
        grams = {tuple(text[p : p + w]) for w in {min(5, len(x)) for x in items} for p in range(len(text) - w + 1)}
        hit = lambda x: any(tuple(x[q : q + min(5, len(x))]) in grams for q in range(len(x) - min(5, len(x)) + 1))  # noqa: B023, E731
        if i is None or not any(hit(x) and plain_tiling(text, x, 5)[1] >= 0.5 * len(x) for x in items if x):
            kept.append((i, t))
    out = []
    for i, t in kept:
        spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in p.finditer(t) if holds(kind, m[0]))
        done, at = "", 0
        for s, _, e, kind in spans:
            if s >= at:
                done += t[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        out.append((i, done + t[at:]))
    return out


def test_run_equals_the_plain_version(spark, folder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*c).collect()]
    want = plain(read("documents", "doc_id", "text"), [x for (x,) in read("benchmark", "text")])
    codes = {i: np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4") for i, text in want}
    got, sequences = collections.defaultdict(list), collections.Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]] += r["length"]
    assert got.keys() == codes.keys() and {90004, 90005, 90006} & got.keys() == set() and {90007, 90008, 90009, None} <= got.keys()
    for i, ids in codes.items():
        at = 0
        for r in sorted(got[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert max(sequences.values()) <= 2048


def test_stages_keep_columns_and_bear_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"score": F.lit(1), "base": F.lit("b"), "key": F.lit(2), "lang_pred": F.lit("x")})
    kept = docs.limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns and kept.where("base = 'b' and key = 2 and score = 1 and lang_pred = 'x'").count() == kept.count() > 0, name
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
