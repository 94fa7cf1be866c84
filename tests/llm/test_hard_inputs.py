"""Deep pages, repeated words and repeated rows."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlake.llm import decontamination, html_text, language_id
from driftlake.llm.ann import nearest
from driftlake.llm.decontamination import benchmark_overlap
from driftlake.llm.queries import QUERIES


@pytest.mark.parametrize("page", ["<div>x, y {n}", "<div>{n}</p>", "<div>{n}<header>h</header>", "<p><table><tr><td><span>{n}<hr><div>k</div>", "<ul><li><span>{n}<li>z"])
def test_deep_pages_take_time_that_grows_with_them(page):
    head, _, tail = page.partition("{n}")
    took = []
    for n in (5_000, 40_000):
        start = time.process_time()
        html_text.main_text(head * n + tail * n)
        took.append(time.process_time() - start)
    assert took[1] < 25 * max(took[0], 0.05)


def test_hidden_text_and_adverts_go_and_white_space_and_order_stay():
    page = """<html><body><div class="top-menu">Menu, and, more</div><article><h1>A  title</h1>
    <p>Main   text,\n long <b>enough</b>, with&nbsp;commas.</p><p style="display: none">hid, den</p>text between<div id="google_ads_iframe_1">ad, ad</div>
    <ins class="adsbygoogle">ad, ad</ins><div class="gdpr-notice">we, use</div><ul><li>one<li>two, <i>th</i>ree</ul><p style="color:red">Last.</p></article></body></html>"""
    assert html_text.main_text(page) == "A title Main text, long enough, with commas. text between one two, three Last."


def test_pages_table_empty_and_clashing(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a, b", "mine")], "page_id long, url string, html string, text string")
    assert html_text.extract(pages.limit(0)).collect() == []
    assert html_text.extract(pages, keep=("page_id", "text")).collect() == [(1, "mine", "a, b")]


def plain(text, item, seed):
    marked_t, marked_i, out = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(text)):
                k = 0
                while p + k < len(text) and q + k < len(item) and text[p + k] == item[q + k] and p + k not in marked_t and q + k not in marked_i:
                    k += 1
                if k >= seed and (best is None or (-k, q, p) < best):
                    best = (-k, q, p)
        if best is None:
            return out
        k, q, p = -best[0], best[1], best[2]
        out.append((p, q, k))
        marked_t |= set(range(p, p + k))
        marked_i |= set(range(q, q + k))


@pytest.mark.parametrize("pairs", [1 << 20, 0])
def test_tiles_of_repeated_words(monkeypatch, pairs):
    monkeypatch.setattr(decontamination, "PAIRS", pairs)
    rng = random.Random(4)
    for _ in range(120):
        letters = rng.choice([1, 2, 3])
        text, item = ([rng.randrange(letters) for _ in range(rng.randrange(3, n))] for n in (40, 20))
        places = [{}, {}]
        for side, words in zip(places, (text, item), strict=True):
            for i in range(len(words) - 2):
                side.setdefault(tuple(words[i : i + 3]), []).append(i)
        seeds = [(np.array(p), np.array(places[1][s])) for s, p in places[0].items() if s in places[1]]
        if seeds:
            assert decontamination.tiles(seeds, 3, len(item)) == plain(text, item, 3)


def test_a_page_of_one_word_meets_an_item_of_it(spark):
    docs = spark.createDataFrame([(1, "a " * 100_000), (2, "a " * 30 + "b"), (1, "a " * 100_000)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a " * 1000), (7, "a " * 1000)], "item_id long, text string")
    got = benchmark_overlap(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["n_tiles"], r["matched_tokens"], r["item_tokens"]) for r in got] == [(1, 7, 1, 1000, 1000)]


def test_rows_that_repeat_an_id_are_neighbours_of_their_own(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [0.5, 0.1], "x")], "vec_id long, embedding array<float>, rank string")
    got = nearest(rows, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 1), (2, 1), (3, 2)]
    few = nearest(rows, F.col("vec_id") < 2, 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == [(0, 1, 1), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 2)]


def test_ties_at_the_last_rank_go_to_smaller_ids(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0] if i else [2.0, 0.0]) for i in range(40)], "vec_id long, embedding array<float>")
    got = nearest(rows, F.col("vec_id") == 0, 5).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2, 3, 4, 5]


def plain_language(labelled, texts):
    """Word-first backoff by its definition: log frequencies by language of known words, else of the longest known n-grams."""
    split = lambda t: [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower()) if w]
    langs = sorted({g for _, g in labelled})
    words = {g: collections.Counter(w for t, h in labelled if h == g for w in split(t)) for g in langs}
    tables = [words]
    for k in range(1, 6):
        tables.append({g: collections.Counter() for g in langs})
        for g in langs:
            for w, n in words[g].items():
                for i in range(len(w) - k + 1):
                    tables[k][g][w[i : i + k]] += n
    known = [set().union(*t.values()) for t in tables]
    total = [{g: sum(t[g].values()) for g in langs} for t in tables]
    log = lambda k, x, g: math.log((tables[k][g][x] + 0.5) / (total[k][g] + 0.5 * (len(known[k]) + 1)))

    def word(w):
        if w in known[0]:
            return [log(0, w, g) for g in langs]
        for k in range(5, 0, -1):
            hits = [w[i : i + k] for i in range(len(w) - k + 1) if w[i : i + k] in known[k]]
            if hits:
                return [sum(log(k, x, g) for x in hits) / len(hits) for g in langs]
        return [0.0] * len(langs)

    for t in texts:
        own = split(t)
        if not any(c.isalpha() for c in t or ""):
            yield "und", 0.0
            continue
        sums = np.sum([word(w) for w in own], 0) / max(1, len(own)) * min(len(own), 30) if own else np.zeros(len(langs))
        odds = np.exp(sums - sums.max())
        yield langs[int(sums.argmax())], float(odds.max() / odds.sum())


def test_op2_is_word_first_backoff(spark):
    """The query on all documents, of which the small table's are all in the sample, and unseen words."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    labelled = [(r["text"], r["lang"]) for r in rows if r["lang"] and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op2_language_id"](spark, "/root/testdata/sf0.001").collect()}
    for r, (lang, score) in zip(rows, plain_language(labelled, [r["text"] for r in rows]), strict=True):
        assert got[r["doc_id"]][1] == pytest.approx(score, abs=1e-3)
        assert got[r["doc_id"]][0] == lang or score < 0.51
    odd = ["zzqqx", "Straßenbahnhaltestelle", "ñññ", "über 123 ch", "x" * 50, "", "12 !", None, "日本"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    model = language_id.fit(spark.createDataFrame(labelled, "text string, lang string").withColumn("doc_id", F.monotonically_increasing_id()))
    told = language_id.predict(docs, model).orderBy("doc_id").collect()
    for r, (lang, score) in zip(told, plain_language(labelled, odd), strict=True):
        assert r["score"] == pytest.approx(score, abs=1e-3) and (r["lang_pred"] == lang or score < 0.51)


def test_a_bounded_sample_keeps_all_its_words(spark):
    docs = spark.createDataFrame([(i, f"wort{i} haus", "de") for i in range(300)] + [(1000 + i, f"mot{i} maison", "fr") for i in range(300)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, n_cells=1 << 9)
    assert model.langs == ["de", "fr"] and 20 < len(model.words) < 300
    assert len(language_id.fit(docs).words) == 602 and language_id.fit(docs.limit(0)).langs == []
