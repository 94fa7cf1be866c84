import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlake.llm import chat_format, html_text, language_id, pii
from driftlake.llm.ann import nearest
from driftlake.llm.decontamination import benchmark_overlap, tiles
from driftlake.llm.jaccard_join import jaccard_classes
from driftlake.llm.language_model import score_documents
from driftlake.llm.packing import cuts, pack
from driftlake.llm.substring_dedup import remove_repeats

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string"


@pytest.fixture(scope="module")
def hard(spark):
    """Copies, near copies, shared passages; nulls, empty texts, repeated rows; a column named as the operators' own."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [r.choices(words, k=r.choice([3, 60, 200])) for _ in range(60)]
    passage = r.choices(words, k=70)
    texts = [" ".join(b) for b in base]
    for i in range(40):
        b = list(base[i % 12])
        for _ in range(i % 9):
            b[r.randrange(len(b))] = "x" + str(r.random())
        texts.append(" ".join(b))
    texts += [" ".join(r.choices(words, k=30) + passage + r.choices(words, k=20)) for _ in range(10)] + ["", None, "one", "one", " \t\n"]
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id " + texts[0], "x")], SCHEMA), dict((a, b) for a, b, _ in rows)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_remove_repeats(hard, none):
    docs, texts = hard
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][j : j + 50]), i)
    got = {r["doc_id"]: r for r in remove_repeats(docs).collect()}
    for i, w in words.items():
        gone = {p for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for p in range(j, j + 50)}
        assert got[i]["kept_text"] == " ".join(x for p, x in enumerate(w) if p not in gone)
    assert got[None]["removed"] == [] and remove_repeats(none).count() == 0


def test_jaccard_classes(hard, none):
    docs, texts = hard
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_classes(docs).collect() if r["doc_id"] is not None}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    assert jaccard_classes(none).count() == 0


def test_packing(hard, none):
    from driftlake.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    docs, texts = hard
    t = Tokenizer.from_file(tokenizer_path())
    pieces = collections.defaultdict(list)
    sequences = collections.Counter()
    for r in pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), tokenizer_path(), size=256).collect():
        pieces[r["doc_id"]].append((r["start"], np.frombuffer(r["token_ids"], "<u4").tolist()))
        sequences[r["sequence_id"]] += r["length"]
    assert max(sequences.values()) <= 256
    for i, text in texts.items():
        assert sum((p for _, p in sorted(pieces[i])), []) == [*t.encode(text or "", add_special_tokens=False).ids, 1]
    assert pack(none, tokenizer_path()).count() == 0


def test_cuts_are_the_best():
    r = random.Random(1)
    for _ in range(50):
        bounds = np.cumsum([0] + [r.randint(1, 9) for _ in range(8)])
        costs = np.array([r.choice([0, 3]) for _ in bounds], float)

        def price(ends):
            return sum(12 - (b - a) for a, b in zip([0, *ends[:-1]], ends)) + sum(costs[list(bounds).index(e)] for e in ends)

        every = [[int(b) for k, b in enumerate(bounds[1:-1]) if m >> k & 1] + [int(bounds[-1])] for m in range(1 << 7)]
        best = min(price(e) for e in every if all(b - a <= 12 for a, b in zip([0, *e[:-1]], e)))
        assert price([int(bounds[j]) for j in cuts(bounds, costs, 12)]) == best


def test_tiles_catch_reordered_passages(spark, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    moved = "zz Eta theta, iota kappa lambda mu. yy alpha beta gamma delta epsilon zeta xx"
    docs = spark.createDataFrame([(1, moved, ""), (2, "alpha beta and nothing else at all", ""), (3, None, ""), (4, item, "")], SCHEMA)
    items = spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_tiles"], r["coverage"]) for r in benchmark_overlap(docs, items).collect()}
    assert got == {(1, 7): (2, 1.0), (4, 7): (1, 1.0)}
    assert benchmark_overlap(none, items).count() == 0
    assert tiles([(np.array([0, 9]), np.array([0])), (np.array([1]), np.array([1]))], 5, 6) == [(0, 0, 6)]


def test_language_id(spark, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    rows = language_id.predict(docs, model).where(language_id.held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    odd = spark.createDataFrame([(1, None, ""), (2, "", ""), (3, "123 !!", ""), (4, "zzzzqq", "")], SCHEMA)
    assert [r["lang_pred"] == "und" for r in language_id.predict(odd, model).orderBy("doc_id").collect()] == [True, True, True, False]
    assert language_id.predict(none, model).count() == 0


def test_chat_fold_and_round_trip(spark):
    log = [(1, 1, 1, "delta", "user", "a<|im_end|>"), (1, 2, 2, "delta", "assistant", "x"), (1, 2, 3, "regenerate", None, None), (1, 2, 4, "delta", None, "be"), (1, 2, 5, "delta", None, r"st <\|"), (1, 1, 6, "edit", "user", "A\n<|"), (1, 3, 7, "delta", "user", "gone"), (1, 3, 8, "delete", None, None), (2, 1, 1, "delta", "assistant", None)]
    events = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["trained"]) for r in chat_format.read_back(chat_format.render(chat_format.final_messages(events))).collect()}
    assert got == {1: ([("user", "A\n<|"), ("assistant", r"best <\|")], [r"best <\|"]), 2: ([("assistant", "")], [""])}


def test_html(spark):
    page = "<html><body><nav><a href=/>Menu</a></nav><div class='main'><h2>Title &amp; more</h2><p>First, long <b>para</b>graph, with commas, and text.<p>Second &lt;one&gt;.</div><div class=sidebar><p>No, no, no, no.</p></div><div id=comments><p>Me, too, yes, yes.</p></div><script>var x='<p>'</script><footer>(c)</footer></body></html>"
    assert html_text.main_text(page) == "Title & more First, long paragraph, with commas, and text. Second <one>."
    assert [html_text.main_text(x) for x in (None, "", "<p>", "< 3 <b")] == ["", "", "", "< 3"]
    rows = spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")
    assert html_text.extract(rows).collect()[0]["text"] == ""


def test_nearest(spark):
    r = np.random.default_rng(0)
    vectors = r.normal(size=(400, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0].tolist()) for i in range(60)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for x in nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append(x["vec_id"])
    ids = np.array([i for i, v in rows if i < 2000])
    table = np.array([v for i, v in rows if i < 2000])
    hits = []
    for q in ids[ids % 20 == 0]:
        s = table @ table[ids == q][0]
        s[ids == q] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -s))[:20]]) & set(got[q])) / 20)
    assert set(got) == set(ids[ids % 20 == 0].tolist()) and np.mean(hits) >= 0.9
    assert nearest(df.where("vec_id >= 2000 and vec_id <> 2003"), F.lit(True)).count() == 0


def test_language_model(hard, none):
    docs, texts = hard
    docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in score_documents(docs, F.col("doc_id") % 2 == 0).collect()}
    counts = collections.Counter()
    for i, t in texts.items():
        if i % 2 == 0:
            counts.update([*WORD.findall((t or "").lower()), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        tokens = [*WORD.findall((t or "").lower()), None]
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert got[i]["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
        assert got[i]["score"] < 0
    assert score_documents(none, F.lit(True)).count() == 0


def plain_tree(counts, asked, depth):
    """Context-tree weighting by dictionaries: log10 of each asked (context, next byte), contexts nearest byte first."""
    nodes = collections.defaultdict(lambda: [0, 0])
    for (c, x), n in counts.items():
        for b in range(8):
            for d in range(depth + 1):
                nodes[d, c[:d], 1 << b | x >> (8 - b)][x >> (7 - b) & 1] += n
    kt = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for k, (a, b) in nodes.items()}
    below = collections.Counter()
    part = {}
    for k in sorted(nodes, reverse=True):
        d, c, bits = k
        w = kt[k] if d == depth else np.logaddexp(kt[k], below[k]) - math.log(2)
        part[k] = 1.0 if d == depth else 1 / (1 + math.exp(min(700, below[k] - kt[k])))
        below[d - 1, c[:-1], bits] += w
    out = {}
    for c, x in asked:
        total = 0
        for b in range(8):
            given, share, one = 0.0, 1.0, 0.5
            for d in range(depth + 1):
                if (k := (d, c[:d], 1 << b | x >> (8 - b))) not in nodes:
                    break
                q = (nodes[k][1] + 0.5) / (sum(nodes[k]) + 1)
                one, given, share = given + share * q, given + share * part[k] * q, share * (1 - part[k])
            total += math.log10(one if x >> (7 - b) & 1 else 1 - one)
        out[c, x] = total
    return out


def test_tree_keeps_every_context(spark):
    """More grams than the 2**17 that a level once kept: each has the score of the whole tree."""
    from driftlake.llm.language_model import DEPTH, score_grams

    r = random.Random(5)
    grams = {(bytes(r.choices(b"abcdefgh", k=DEPTH)), r.choice(b"abcdxyz")): r.choice([0, 1, 1, 2, 5000]) for _ in range(150_000)}
    code = {int.from_bytes(c + bytes([x]), "big"): (c, x) for c, x in grams}
    df = spark.createDataFrame([(k, grams[v]) for k, v in code.items()], "key long, n long")
    got = {code[x["key"]]: x["tree"] for x in score_grams(df).collect()}
    assert len(got) > 1 << 17 and got.keys() == grams.keys()
    some = sorted(grams)[::200]
    want = plain_tree({k: n for k, n in grams.items() if n}, some, DEPTH)
    assert [got[k] for k in some] == pytest.approx([want[k] for k in some])


@pytest.mark.parametrize("under", [20, 300])
def test_heavy_roots_of_the_tree_are_split(spark, under):
    """Most grams share their nearest bytes: no part's root has more than `under`, and scores are those of the whole tree."""
    from driftlake.llm import language_model as m

    r = random.Random(7)
    near = [bytes(r.choices(b"eeeeeeet ", k=m.DEPTH)) for _ in range(3000)] + [bytes(r.choices(b"abcdefgh", k=m.DEPTH)) for _ in range(300)]
    grams = {(c, r.choice(b"abcdefghxyz")): r.choice([0, 1, 2, 700]) for c in near for _ in range(3)}
    grams |= {(b"qqqqqq", x): 0 for x in range(120)}
    code = {int.from_bytes(c + bytes([x]), "big"): (c, x) for c, x in grams}
    df = spark.createDataFrame([(k, grams[v]) for k, v in code.items()], "key long, n long")
    sizes = m._cut(df, under).groupBy("root", "first").count().collect()
    assert all(x["count"] <= under or x["root"] == m.DEPTH for x in sizes) and sum(x["count"] for x in sizes) == len(grams)
    assert {x["root"] for x in sizes} > {m.ROOT}
    got = {code[x["key"]]: x["tree"] for x in m.score_grams(df, under).collect()}
    assert got == pytest.approx(plain_tree({k: n for k, n in grams.items() if n}, grams, m.DEPTH))


def test_language_model_reads_across_words(hard):
    """The tree's scores are those of the running text, whether grams are held by tasks or joined."""
    from driftlake.llm.language_model import DEPTH

    docs, texts = hard
    docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"])

    def grams(t):
        s = b"\0" * (DEPTH - 1) + b" " + b"".join(w.encode() + b" " for w in WORD.findall((t or "").lower())) + b"\n"
        return [(s[i - DEPTH : i][::-1], s[i]) for i in range(DEPTH, len(s))]

    counts = collections.Counter(g for i, t in texts.items() if i % 2 == 0 for g in grams(t))
    want = plain_tree(counts, {g for t in texts.values() for g in grams(t)}, DEPTH)
    for hot in (0, 300, 1 << 20):
        got = {r["doc_id"]: r["score"] for r in score_documents(docs, F.col("doc_id") % 2 == 0, hot_grams=hot).collect()}
        assert got == pytest.approx({i: sum(want[g] for g in grams(t)) for i, t in texts.items()})


def test_pii(spark):
    texts = ["a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 999.1.1.1", "4111 1111-1111 1111, 4111111111111112", "é +1 (555) 123-4567.", "", None, "9" * 3000, "a" * 30000]
    texts += [f"reach her phone +1 (555) 123-45{i:02d} now" for i in range(40)] + ["reach her phone 555 now", "reach her phone 555-123-9999 now"]
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in pii.redact(pii.find(docs).withColumn("all", pii.joined(F.col("spans"))).withColumn("seeds", pii.joined(F.col("base")))).collect()}
    assert [got[i]["seeds"] for i in range(8)] == ["email:0:5,email:5:11", "ip:0:7,ip:8:15", "card:0:19", "phone:2:19", "", "", "", ""]
    assert got[2]["text"] == "[CARD], 4111111111111112" and got[5]["text"] is None
    assert got[49]["all"] == "phone:16:28" and got[48]["all"] == ""


def test_pii_few_seeds_and_many_unseen(spark):
    """Five seeds are enough, also where most values are unseen; four aren't, nor five with values that can't be phones."""
    texts = [f"reach her phone +1 (555) 123-45{i:02d} {i}a" for i in range(5)] + [f"reach her phone 555-123-{i:04d} b{i}" for i in range(50)]
    texts += [f"ask its line +1 (555) 323-45{i:02d} {i}c" for i in range(4)] + ["ask its line 555-323-9999 d"]
    texts += [f"note our code +1 (555) 423-45{i:02d} {i}e" for i in range(5)] + ["note our code 555-423-9999 f"] + [f"note our code ab{i}-{i}cd {i}g" for i in range(100, 104)]
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["text"]: r["all"] for r in pii.find(docs).withColumn("all", pii.joined(F.col("spans"))).collect()}
    assert all(got[f"reach her phone 555-123-{i:04d} b{i}"] == "phone:16:28" for i in range(50))
    assert got["ask its line 555-323-9999 d"] == "" and got["note our code 555-423-9999 f"] == ""


def test_pii_spaced_values_and_short_labels(spark):
    """Unseen values of several words after a label whose other neighbours never repeat."""
    new = ["555 123 4567", "(555) 123-4567", "555-123-4567", "5551234567", "4111 1111 1111", "0" * 5 + " 12345"]
    texts = [f"w{i}x Tel: +1 (555) 123-45{i:02d} y{i}z" for i in range(20)] + [f"v{i}x Tel: {t}, 2nd{i}" for i, t in enumerate(new)]
    texts += [f"u Tel: ({new[3]}) z", "t Tel: 555 123 4567 2nd s", "9 " * 5000]
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["text"]: r["all"] for r in pii.find(docs).withColumn("all", pii.joined(F.col("spans"))).collect()}
    for i, t in enumerate(new):
        assert got[f"v{i}x Tel: {t}, 2nd{i}"] == f"phone:9:{9 + len(t)}"
    assert got[f"u Tel: ({new[3]}) z"] == "phone:8:18" and got["t Tel: 555 123 4567 2nd s"] == "phone:7:19" and got["9 " * 5000] == ""
