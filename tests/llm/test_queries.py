"""Every registered query of the subpackage against a plain version of it."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from driftlake.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(i, by):
    return zlib.crc32(str(i).encode()) % by


@pytest.fixture(scope="module")
def docs(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    return {i: rows[i] for i in sorted(rows)}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for i, x in docs.items()}
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows(spark, "op1_packing"):
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
        got[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in ids.items():
        ends = np.cumsum([n for _, n in sorted(got[i])])
        assert [s for s, _ in sorted(got[i])] == [0, *ends[:-1]] and ends[-1] == len(own)
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(map(len, ids.values())) > 0.9 * 2048 * (len(sequences) - 8)


def test_op2(spark, docs):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in rows(spark, "op2_language_id")}
    assert got.keys() == docs.keys() and all(r["held_out"] == (remainder(i, 5) == 0) for i, r in got.items())
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in docs[i] or "")) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert np.mean([r["lang_pred"] == lang[i] for i, r in got.items() if r["held_out"] and lang[i]]) > 0.95


def test_op3(spark):
    turns = collections.defaultdict(list)
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [(role, "<|im_end|><|im_start|>assistant ok") for role in ("user", "assistant")]
    got = {r["conv_id"]: r for r in rows(spark, "op3_chat_format")}
    assert got.keys() == turns.keys()
    escape = lambda t: re.sub(r"<(\\*)\|", lambda m: "<\\" + m[1] + "|", t)
    for i, own in turns.items():
        loss = "".join(t for role, t in own if role == "assistant")
        whole = "".join(f"<|im_start|>{role}\n{escape(t)}<|im_end|>\n" for role, t in own)
        want = (len(own), sha("".join(f"{role}\n{t}\n" for role, t in own)), len(loss), sha(loss), len(whole))
        assert tuple(got[i])[1:] == want


def test_op4(spark):
    """These pages have one article, of paragraphs in a plain form."""
    import html

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows(spark, "op4_html_text"):
        article = re.search(r"<article>(.*?)(</article>|<footer>)", pages[r["page_id"]]["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1|br|div)\b[^>]*>", article[1]) if article else []
        want = " ".join(filter(None, (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)))
        got = r["text"].replace(" ", "")
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"]) and got == want.replace(" ", "")


def plain_tiling(text, item, tile):
    """Greedy string tiling by its definition: the longest match of unmarked words, earliest in the item, then the text."""
    a, b, total, count = [False] * len(text), [False] * len(item), 0, 0
    tile = min(tile, len(item))
    where = collections.defaultdict(list)
    for p in range(len(text) - tile + 1):
        where[tuple(text[p : p + tile])].append(p)
    while tile:
        best = None
        for q in range(len(item) - tile + 1):
            for p in where.get(tuple(item[q : q + tile]), ()):
                k = 0
                while q + k < len(item) and p + k < len(text) and item[q + k] == text[p + k] and not a[p + k] and not b[q + k]:
                    k += 1
                if k >= tile and (best is None or k > best[0]):
                    best = (k, q, p)
        if best is None:
            break
        k, q, p = best
        a[p : p + k] = b[q : q + k] = [True] * k
        total, count = total + k, count + 1
    return count, total


def test_op5(spark, docs):
    words = lambda t: re.findall(r"[^\x00-\x7f]+(?:[0-9A-Za-z\u0080-\U0010ffff]+)*|[0-9A-Za-z][0-9A-Za-z\u0080-\U0010ffff]*", lower(t))
    assert words("a,B c_d é-f") == ["a", "b", "c", "d", "é", "f"]
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {}
    for i, t in docs.items():
        text = words(t)
        grams = {tuple(text[p : p + w]) for w in {min(5, len(x)) for x in items.values()} for p in range(len(text) - w + 1)}
        for j, item in items.items():
            w = min(5, len(item))
            if w and any(tuple(item[q : q + w]) in grams for q in range(len(item) - w + 1)):
                count, total = plain_tiling(text, item, 5)
                if total >= 0.5 * len(item):
                    want[i, j] = (count, total, len(item))
    got = {(r["doc_id"], r["item_id"]): (r["n_tiles"], r["matched_tokens"], r["item_tokens"]) for r in rows(spark, "op5_decontamination")}
    assert got == want and want


def test_op6(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r["embedding"] is not None}
    ids = np.array(sorted(i for i, v in vectors.items() if np.isfinite(v).all() and v.any()))
    table = np.array([vectors[i] for i in ids])
    got = collections.defaultdict(list)
    for r in sorted(rows(spark, "op6_nearest"), key=lambda r: (r["query_id"], r["rank"])):
        assert r["score"] == pytest.approx(float(vectors[r["query_id"]] @ vectors[r["vec_id"]]), rel=1e-12)
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    hits = []
    for q in ids[ids % 20 == 0]:
        s = table @ vectors[q]
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        assert [k for k, _ in got[q]] == [*range(1, len(best) + 1)]
        hits.append(len({v for _, v in got[q]} & set(best.tolist())) / len(best))
    assert np.mean(hits) >= 0.9


def test_op7(spark, docs):
    sets = {}
    for i, t in docs.items():
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op7_jaccard_join")} == {i: (len(sets[i]), find(i)) for i in sets}


def test_op8(spark, docs):
    words = {i: [*WORD.findall(lower(t)), None] for i, t in docs.items()}
    counts = collections.Counter(w for i, own in words.items() if remainder(i, 10) for w in own)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in rows(spark, "op8_language_model")}
    assert got.keys() == docs.keys()
    for i, own in words.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (remainder(i, 10) == 0, len(own), sum(counts[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)) and r["score"] < 0
    # of few documents the tree learns how words are spelled: well under the eight bits of a byte
    held = [i for i, r in got.items() if r["held_out"]]
    size = sum(len(" ".join(w or "" for w in words[i]).encode()) + 1 for i in held)
    assert -sum(got[i]["score"] for i in held) * np.log2(10) / size < 3


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def holds(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_op9(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op9_pii")}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in p.finditer(t or "") if holds(kind, m[0]))
        base = [f"{kind}:{s}:{e}" for s, _, kind, e in spans]
        r = got[i]
        assert [r[f"n_{kind}"] for kind in PLAIN] == [sum(x[2] == kind for x in spans) for kind in PLAIN]
        assert r["base_sha256"] == sha(",".join(base)) and set(base) <= set(r["spans"].split(",")) | {""} - set(base)


def test_op10(spark, docs):
    words = {i: WORD.findall(t or "") for i, t in docs.items()}
    first = {}
    for i, w in words.items():
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    got = {r["doc_id"]: r for r in rows(spark, "op10_substring_dedup")}
    for i, w in words.items():
        gone = {p for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for p in range(j, j + 50)}
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    assert any(r["n_removed"] for r in got.values())
