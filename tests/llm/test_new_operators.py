"""Whitening, quality and alignment against plain versions, with hard rows."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftlake.llm import alignment, quality, whitening
from driftlake.llm.queries import QUERIES, tokenizer_path
from driftlake.llm.scratch import write_shared

SF = "/root/testdata/sf0.001"
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SPELL = alignment.byte_bpe(A)[2], alignment.piece_bpe(B)[2]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HARD = [
    "a\0b  c\n\td <s> <0x41> ▁x </s><unk>", "  x", "x ", "\n", "\n\nx y", "x  y  z", "x 　y", "à b à  c", " ", "<|endoftext|> a", "日本語 テキスト 😀 x\ny\r\nz",
    "it's don't 12345 67 a.b\n- x", "x\u0085 y\u001c z", "é x", "﻿x y", "a " * 3000 + "b", "x" * 5000, "\n a\nb", "a\n b", "é" * 50 + " 中" * 20, "x ▁ y", "", None,
]


@pytest.fixture(scope="module")
def tools():
    return alignment._load(A, B)


def plain_groups(tools, text):
    """The groups as lists of ids, from both encodings of the whole text."""
    if not text:
        return []
    spell_a, spell_b = SPELL
    a, b = tools["a"].encode(" " + text, add_special_tokens=False).ids, tools["b"].encode(text)
    whole = (" " + text).encode()
    if b"".join(spell_a[i] for i in a) != whole or b"".join(spell_b[i] for i in b) != whole:
        return []
    ea, eb = np.cumsum([len(spell_a[i]) for i in a]).tolist(), np.cumsum([len(spell_b[i]) for i in b]).tolist()
    out, i, j = [], 0, 0
    for end in sorted(set(ea) & set(eb)):
        x, y = ea.index(end, i) + 1, eb.index(end, j) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def as_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def check_alignment(texts, got, tools):
    """got: rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, sha256) in the order of texts."""
    every = [plain_groups(tools, t) for t in texts]
    links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in every]
    counts = collections.Counter(p for own in links for p in own)
    best: dict = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    for g, own, r in zip(every, links, got, strict=True):
        want = (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), sum(k for p, k in own.items() if counts[p] == best[p[0]]), sum(k * counts[p] for p, k in own.items()))
        assert tuple(r)[:6] == want
        assert r[6] == (hashlib.sha256(as_text(g).encode()).hexdigest() if g else "")


def test_op13(spark, tools):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_alignment"](spark, SF).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    check_alignment(list(texts.values()), [got[i] for i in texts], tools)


def aligned(spark, texts):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_a long")
    return write_shared(alignment.align(docs.repartition(3), A, B), "aligned")


@pytest.mark.parametrize("held", [1 << 20, 40, 0])
def test_alignment_of_hard_texts_with_held_and_joined_counts(spark, tools, monkeypatch, held):
    monkeypatch.setattr(alignment, "HELD", held)
    texts = [*HARD, "Äther über Maßstäbe " * 5, "Äther über Maßstäbe " * 5, "internationalisation deinstitutionalised"]
    rows = alignment.weigh(aligned(spark, texts), A, B).orderBy("doc_id").collect()
    digest = lambda r: hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""
    check_alignment(texts, [(*[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], digest(r)) for r in rows], tools)


def test_alignment_of_no_rows_null_ids_and_repeated_rows(spark, tools):
    assert alignment.weigh(aligned(spark, []), A, B).collect() == []
    docs = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    rows = alignment.weigh(write_shared(alignment.align(docs, A, B), "aligned"), A, B).collect()
    assert sorted((r["doc_id"] is None, r["n_groups"], r["count_sum"]) for r in rows) == [(False, 0, 0), (False, 2, 6), (False, 2, 6), (True, 2, 6)]


def test_wide_groups_are_counted_before_they_are_paired(monkeypatch):
    a, b = np.array([1, 2, 2, 3, 9]), np.array([5, 5, 6, 4])
    ga, gb = np.array([0, 0, 0, 0, 1]), np.array([0, 0, 0, 1])
    whole = alignment._links(a, b, ga, gb, 2, 100)
    monkeypatch.setattr(alignment, "WIDE", 4)
    short = alignment._links(a, b, ga, gb, 2, 100)
    totals = [collections.Counter() for _ in range(2)]
    for total, (pairs, times, group) in zip(totals, (whole, short), strict=True):
        for p, t, g in zip(pairs.tolist(), times.tolist(), group.tolist(), strict=True):
            total[p, g] += t
    assert totals[0] == totals[1] and len(short[0]) == 7 and (np.diff(short[2]) >= 0).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'sé▁ \n\t\r  　1.,-|中😀́")), max_size=30), min_size=1, max_size=4))
def test_alignment_of_any_texts(texts):
    tools = alignment._load(A, B)
    texts = [t for t in texts if t]
    for t, found in zip(texts, alignment._block(tools, [b" " + t.encode() for t in texts]) if texts else (), strict=True):
        assert found[0].decode() == as_text(plain_groups(tools, t))


def plain_figures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {i + k for own in at.values() if len(own) > 1 for i in own for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def plain_score(model, text):
    """The model's probability from n-grams in plain Python, whose buckets come from the module's hashes of one n-gram at a time."""
    grams = [quality._grams(b) for b in quality.text_blocks(quality.pa.RecordBatch.from_pydict({"text": [text or ""]}), fold=quality.AS_IS)][0]
    words, letters = WORD.findall(text or ""), text or ""
    sizes = [max(0, len(words) - k + 1) for k in quality.WORD_GRAMS] + [max(0, len(letters) - k + 1) for k in quality.CHAR_GRAMS]
    assert [len(b) for b, _ in grams] == sizes
    margin = model.intercept + sum(math.fsum(model.weights[b].tolist()) / max(1, len(b)) for b, _ in grams)
    return 1 / (1 + math.exp(-model.slope * margin - model.offset))


def test_op12(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op12_quality"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        n = plain_figures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= 0.5)


def test_quality_of_hard_texts(spark):
    line = "one two three four five six seven eight nine"
    texts = [*HARD, f"{line}\n{line}\n{line} \n\n\n", f"x {line} y {line}", "a\n\na\n \n \nb\ta\n", ("w " * 9 + "v ") * 30, "#*$%&|<> ## é|"]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)] + [(None, "x", "mine")], "doc_id long, text string, score string")
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=quality.FAMILIES << quality.BITS).astype(np.float32), 0.25, 1.5, -0.5)
    rows = quality.judge(docs.repartition(3), model).collect()
    assert len(rows) == len(texts) + 1 and {r["score"] for r in rows} == {"mine"}
    for r in rows:
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_figures(text)
        assert r["score_"] == pytest.approx(plain_score(model, text), abs=1e-6)
    assert quality.judge(docs.limit(0), model).collect() == []


def test_equal_ngrams_share_buckets_and_others_hardly_do():
    def buckets(text):
        block = next(iter(quality.text_blocks(quality.pa.RecordBatch.from_pydict({"text": [text]}), fold=quality.AS_IS)))
        return [b.tolist() for b, _ in quality._grams(block)]

    one, two = buckets("abcd abcd xyz"), buckets("qq abcd abcd")
    assert one[0][0] == one[0][1] == two[0][1] and one[1][0] == two[1][1] and set(one[2]) & set(two[2])
    many = buckets(" ".join(f"w{i}" for i in range(2000)))
    assert len(set(many[0])) > 1850
    assert all(i << quality.BITS <= b < (i + 1) << quality.BITS for i, own in enumerate(many) for b in own)


def test_quality_is_learned_and_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality")
    told = quality.judge(docs, quality.fit(docs, labels.where("doc_id % 4 > 0"))).join(labels.where("doc_id % 4 = 0"), "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] > 0) for r in told]) > 0.95
    assert np.mean([r["kept"] for r in told if r["quality"] > 0]) > 0.97
    assert abs(np.mean([r["score"] for r in told]) - np.mean([r["quality"] for r in told])) < 0.1


def test_quality_with_few_labels_or_none(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20), (2, None), (1, "a b c " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r["score"], 3) for r in quality.judge(docs, quality.fit(docs, none)).collect()} == {1.0}
    one = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert {round(r["score"], 3) for r in quality.judge(docs, quality.fit(docs, one)).collect()} == {0.0}
    both = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 1)], "doc_id long, quality int")
    assert len(quality.judge(docs, quality.fit(docs, both)).collect()) == 3


def plain_whitening(vectors, most=16):
    x = {i: np.array([math.floor(64 * float(c)) + 1_000_000 for c in v], object) for i, v in vectors}
    fit = np.array(list({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(0)
    z = ((n * fit - s) / n).astype(np.float64)
    values, vecs = np.linalg.eigh(z.T @ z / n)
    values, vecs = values[::-1][:most], vecs[:, ::-1][:, :most]
    return n, {i: int(((n * v - s) ** 2).sum()) for i, v in x.items()}, {i: ((n * v - s) / n).astype(np.float64) @ vecs / np.sqrt(values) for i, v in x.items()}, values / np.trace(z.T @ z / n)


def check_whitening(rows, vectors):
    n, deviation, whitened, explained = plain_whitening(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * len(explained)
    for k in range(len(explained)):
        sign = np.sign(sum(got[i, k + 1]["whitened"] * whitened[i][k] for i, _ in vectors))
        for i, _ in vectors:
            r = got[i, k + 1]
            assert (r["n"], r["deviation"]) == (n, deviation[i]) and r["identity_error"] < 1e-8
            assert r["whitened"] == pytest.approx(sign * whitened[i][k], abs=1e-7) and r["explained"] == pytest.approx(explained[k], rel=1e-9)


def test_op11(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening(QUERIES["op11_whitening"](spark, SF).collect(), [(r["vec_id"], r["embedding"]) for r in rows])


def whitened(df):
    rows = whitening.usable(df)
    return whitening.whiten(rows, whitening.fit(rows))


def test_whitening_of_hard_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=5) * [4, 3, 2, 1, 1]).tolist()) for i in range(40)]
    good += [(100, good[0][1]), (101, [c + 1e-9 for c in good[0][1]]), (102, [1e3, -1e3, 0.0, 0.0, 0.0])]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] + [0.0] * 4), (204, []), (205, [1.0])]
    df = spark.createDataFrame([(i, v, "mine") for i, v in good + bad], "vec_id long, embedding array<double>, n string")
    rows = whitened(df.repartition(4)).withColumnRenamed("n_", "m").drop("n", "embedding").withColumnRenamed("m", "n").collect()
    check_whitening(rows, good)
    assert sorted(whitened(df.drop("n").union(df.drop("n"))).columns) == ["component", "deviation", "embedding", "explained", "identity_error", "n", "vec_id", "whitened"]


def test_whitening_of_few_or_equal_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], kind)).collect() == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []
    two = whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])], kind)).collect()
    assert [(r["vec_id"], r["component"], r["n"], abs(round(r["whitened"], 9)), r["deviation"]) for r in sorted(two)] == [(1, 1, 2, 1.0, 128**2), (2, 1, 2, 1.0, 128**2), (2, 1, 2, 1.0, 128**2)]


def test_deviations_beyond_64_bits_are_exact(spark):
    vectors = [(i, [float(2**33 * (i % 3)), float(i)]) for i in range(6)]
    rows = whitened(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).where("component = 1").collect()
    n, deviation, _, _ = plain_whitening(vectors)
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == deviation and max(deviation.values()) > 2**63


@pytest.mark.parametrize("values", [np.linspace(1, 10, 40), np.r_[np.full(12, 5.0), np.linspace(1, 2, 20)], np.r_[5 + np.arange(12) * 1e-9, np.linspace(1, 2, 20)], np.r_[5 + np.arange(12) * 1e-6, np.linspace(1, 2, 20)], 10.0 ** -np.arange(10), np.zeros(4), np.array([3.0])])
def test_eigenvectors_of_clustered_values_to_double_precision(values):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigen(a)
    size = max(values.max(), 1e-300)
    high = a.astype(np.longdouble)
    assert np.abs(found - np.linalg.eigh(a)[0][::-1]).max() <= 1e-14 * size
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 2e-15
    assert np.abs(high @ x - x * found).max() < 2e-15 * size
