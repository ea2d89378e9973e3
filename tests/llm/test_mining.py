"""Whitening, decontamination and collocations against brute force, with odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxframe.llm import collocations as co
from voxframe.llm import html_extract, topk
from voxframe.llm import decontaminate as de
from voxframe.llm import whitening as wh

ODD = ["", None, " ", "\n\n", "a", "a  b", "tab\tx", "it's 's", "é e\x00f", "ab.cd,ef!gh", "x" * 9000, "no space " * 3000, "!" * 5000, "\U0001f600 ok é9"]
VECTORS = "vec_id long, embedding array<float>, x long, n string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- whitening


def expected(vectors, k=8):
    x = np.array([np.floor(1024.0 * np.float64(np.array(v, np.float32))) for v in vectors])
    v = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    e, u = np.linalg.eigh(v)
    return x - x.mean(axis=0), e[::-1][:k], u[:, ::-1][:, :k], np.trace(v)


def check_whitened(rows, ids, vectors, k):
    centred, e, u, trace = expected(vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(got) == list(range(1, k + 1))
    n = len(vectors)
    whole = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    for c, held in got.items():
        want = centred @ u[:, c - 1] / np.sqrt(e[c - 1])
        have = np.array([held[i].whitened for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        for i, v in zip(ids, whole, strict=True):
            r = held[i]
            assert (r.n, int(r.deviation)) == (n, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)))
            assert abs(r.explained - e[c - 1] / trace) < 1e-9 and r.identity_error < 1e-9


def test_whitening(spark):
    rng = np.random.default_rng(3)
    good = (rng.standard_normal((300, 48)) * np.linspace(2, 0.5, 48) + 3).astype(np.float32).tolist()
    bad = [None, [], [None] * 48, [float("nan")] * 48, [1e38] * 48, [float("-inf"), *[0.0] * 47]]
    rows = [(i, v, 1, "c") for i, v in enumerate([*good, *bad])]
    out = wh.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == 8 * len(good)
    check_whitened(out, list(range(300)), good, 8)


def test_whitening_of_odd_tables(spark):
    f = lambda rows: wh.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert f([]) == [] and f([(1, None, 1, "")]) == [] and f([(1, [0.5, 0.25], 1, "")]) == []
    assert f([(i, [0.5, 0.25, 1.0], 1, "") for i in range(5)]) == []
    # rank one, a null id, and vectors of another length by themselves
    line = [(i if i else None, [i * 1.0, i * 2.0], 1, "") for i in range(6)]
    out = f(line + [(10 + i, [float(i * i)], 1, "") for i in range(4)])
    assert {(r.n, r.component) for r in out} == {(6, 1), (4, 1)} and len(out) == 10
    assert sum(r.vec_id is None for r in out) == 1


def test_leading_pairs_with_ties_and_gaps():
    rng = np.random.default_rng(1)
    u = np.linalg.qr(rng.standard_normal((150, 150)))[0]
    for values in ([1e6, 1e3, *[50.0] * 4, *np.linspace(40, 1, 144)], [5.0, *[0.0] * 149], [1.0] * 150, [0.0] * 150):
        m, seen = u @ np.diag(values) @ u.T, []
        e, b, trace = wh.leading(lambda q, m=m, seen=seen: (seen.append(q.shape), (m @ q, np.trace(m)))[1], 150, 8)
        assert np.abs(e - np.array(values[:8])).max() <= 1e-9 * max(values[0], 1)
        assert np.abs(b.T @ b - np.eye(8)).max() < 1e-10
        assert all(s[1] <= 32 for s in seen)


# ---- decontamination


def words(t):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))


def brute_hits(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((len(w), sorted(hit), sorted(x for x in found if x is not None)))
    return out


@pytest.mark.parametrize("block", [de.BLOCK, 3000])
def test_decontamination(spark, block):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "É1", "dé"]
    text = lambda n, v=vocabulary: " ".join(rng.choice(v) for _ in range(n))
    items = [(str(i), text(rng.randint(4, 9), "abc")) for i in range(12)] + [("20", "A"), ("3", "zz, zz"), ("1", text(9)), (None, "null id"), ("9", None), ("8", ""), ("7", "q " * 12)]
    docs = [*ODD, "null id here", "q " * 30, *(text(rng.randint(1, 60)) for _ in range(60)), *(text(5) + ". " + items[i][1].upper() + "; " + text(3) for i in range(12))]
    docs += docs[-3:]
    frame = spark.createDataFrame([(i % 80, t, 1, "x") for i, t in enumerate(docs)], "doc_id long, text string, n_words int, items string")
    given = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    got = sorted((r.doc_id, r.n_words, sorted(x for s in r.spans for x in range(s.start, s.start + s.length)), list(r["items"]), r.n_hit) for r in de.find_items(frame, given, window=6, block=block).collect())
    want = sorted((i % 80, n, hit, found, len(hit)) for i, (n, hit, found) in enumerate(brute_hits(docs, items, 6)))
    assert got == want


def test_decontamination_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, de.contamination(docs, none).select("doc_id", "n_words", "n_hit", "contaminated").collect())) == [(1, 3, 0, False), (2, 0, 0, False)]
    assert de.contamination(docs.limit(0), some).count() == 0
    assert sorted(map(tuple, de.contamination(docs, some).select("doc_id", "n_hit", "n_items").collect())) == [(1, 2, 1), (2, 0, 0)]


# ---- collocations


def brute_phrases(rows, least, most, inside):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    count[lang, tuple(w[i : i + m])] += 1
    candidates = {k: n for k, n in count.items() if len(k[1]) > 1 and n >= least}
    out = []
    for (lang, p), a in candidates.items():
        if any(lang == x and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * f >= inside * a for (x, q), f in candidates.items()):
            continue
        cuts = [(1_000_000 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]], total[lang]))
    found, rank = [], Counter()
    for lang, score, a, phrase, l, r, n in sorted(out):
        rank[lang] += 1
        if rank[lang] <= most:
            found.append((lang, rank[lang], phrase.decode(), -a, l, r, n, -score))
    return found


@pytest.mark.parametrize("every", [1, 3, 8, 1000])
def test_collocations(spark, every):
    rng = random.Random(every)
    text = lambda n: "".join(rng.choice(["a", "B", "c", "dé", "ü", "new york", "a b c"]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "; "]) for _ in range(n))
    rows = [(t, "en") for t in ODD] + [(text(rng.randint(0, 80)), rng.choice(["en", "en", "de", None])) for _ in range(60)]
    rows += rows[-5:]
    frame = spark.createDataFrame([(t, lang, 1, "z") for t, lang in rows], "text string, lang string, n long, phrase string")
    got = sorted(tuple(r) for r in co.collocations(frame, least=4, most=25, every=every).collect())
    assert got == sorted(brute_phrases(rows, 4, 25, 50))


def test_collocations_of_empty_tables(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(frame).count() == 0
    assert co.collocations(spark.createDataFrame([(None, None), ("", "en"), ("a b", "en")], "text string, lang string")).count() == 0


def test_chunks_hold_each_word_once(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(200)) + ". x" for _ in range(20)]
    frame = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    rows = co.chunk_dictionary(frame, every=4).collect()
    assert sum(r.n * (len(r.chunk.split(" ")) - r.tail) for r in rows) == 20 * 201
    assert len(rows) == len({(r.chunk, r.tail) for r in rows})


# ---- attributes of bad markup, vectors of many lengths


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<article><p data-x=it's>Main text one.</p><p>You don't lose this.</p></article>", ["Main text one.", "You don't lose this."]),
        ("<body><nav>Menu</nav><article><h1>T</h1><p class=it's>Text A isn't.</p><p>B</p>", ["Menu", "T", "Text A isn't.", "B"]),
        ('<p alt="5" tall">x</p>', ["x"]),
        ("<p><![CDATA[ x > y ]]>z</p>", ["z"]),
        ("<p title='a > b' href=x=y?z>t</p><p id=\"never>u</p>", ["t", "u"]),
        ("<a href = 'q>'>link</a> <p class>v</p>", ["link", "v"]),
    ],
)
def test_attributes_of_bad_markup(page, texts):
    assert [b.text for b in html_extract.blocks(page)] == texts


def test_names_come_from_whole_attributes():
    assert [b.path for b in html_extract.blocks("<div data-sidebar-id='menu' title='x class=nav'><p ID=\"main\" class=a>t</p></div>")] == [("div", "p", ".main", ".a")]


def test_top_k_of_many_lengths(spark):
    rows = [(20 * i + j, [float(j)] * (i + 1)) for i in range(20) for j in range(3)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted((20 * i, n, 20 * i + n) for i in range(20) for n in (1, 2))
