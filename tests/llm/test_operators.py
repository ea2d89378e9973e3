"""The corpus operators against brute force, round trips and held-out rows, on small tables with odd cases."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voxframe.llm import bpe_tree, exact_dedup, html_extract, langid, near_dedup, packing, quality, substring_dedup, token_store, topk
from voxframe.llm.common import stage_path
from voxframe.llm.graph import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, cls long, band string"
ODD = ["", None, " ", "\n\n", "a", "a  b", " lead", "tail ", "tab\tx", "it's 's", "x\u0085y  z", "é e", "a | b|c", "<|endoftext|> q", "12 34\n56, 7.8!!", "ΑΣ ΣΑΣ", "\U0001f600 ok", "x" * 9000, "no space " * 3000, "!" * 5000]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t, "en", "s", len(t or ""), 1, 2, "b") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return frame(spark, [*ODD, *rows, rows[0], rows[0]])


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_store(spark, docs, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    path = stage_path(spark, "store")
    token_store.write_store(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    got, at = {r.doc_id: r for r in token_store.read_summary(spark, path).collect()}, 0
    ids = {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}
    for i in sorted(texts):
        want = [*t.encode(texts[i], add_special_tokens=False).ids, 0]
        assert ids[i] == want
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, got[i].verified) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()), True)
        at += len(want)
    assert token_store.verify_manifest(spark, path)
    held = token_store.chunks(spark, path)
    assert held.count() == held.select("digest").distinct().count()


def test_bpe_tree(spark, docs, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    small = bpe_tree.Codec(path, public_tokenizers.PATTERN, leaf=7, window=2)
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice(["a", "b ", " ", "\n", "'s", "1", "ß", "!!", "\U0001f600", " ", "the "]) for _ in range(r.randrange(60)))
        assert small.encode(t) == whole.encode_ordinary(t), repr(t)
        assert small.decode(small.encode(t)) == t.encode()
    for row in bpe_tree.round_trip(docs, path, public_tokenizers.PATTERN).collect():
        ids = whole.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_exact_groups(spark, docs, texts):
    by: dict = {}
    for i, t in texts.items():
        by.setdefault(t, []).append(i)
    for r in exact_dedup.exact_groups(docs).collect():
        mine = by[texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(mine), len(mine), r.doc_id == max(mine), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns and left.count() == len(by)


def brute(texts, k, percent):
    import re

    sets = {}
    for i, t in texts.items():
        w = re.findall("[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_near_groups_equal_brute_force(spark, docs, texts):
    r = random.Random(5)
    base = [r.choice("alpha beta gamma delta epsilon zeta".split()) + str(r.randrange(50)) for _ in range(120)]
    family = []
    for _ in range(60):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        family.append(" ".join(w))
    both = docs.union(frame(spark, family, 10_000))
    all_texts = texts | {10_000 + i: t for i, t in enumerate(family)}
    want = brute(all_texts, 3, 85)
    for row in near_dedup.near_groups(both, k=3, percent=85, bands=32, rows=8, block=16).collect():
        assert (row.n_shingles, row.component_id) == want[row.doc_id], row
        assert row.kept == (row.doc_id == row.component_id)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    assert {(r.node, r.root) for r in connected_components(edges).collect()} == {(i, 0) for i in range(1, 41)} | {(95, 90), (100, 90)}


def test_packing(spark, docs, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), pool_tokens=20_000).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in texts.items():
        ids, at = [*t.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


def test_passages(spark):
    r = random.Random(9)
    word = lambda: f"w{r.randrange(10**7)}"
    passage = [word() for _ in range(70)]
    fuzzy = [w if i % 19 else word() for i, w in enumerate(passage)]
    made = [[word() for _ in range(90)] for _ in range(6)]
    rows = [" ".join(made[0][:40] + passage + made[0][40:]), " ".join(made[1][:10] + passage + made[1][10:]), " ".join(fuzzy + made[2]), " ".join(made[3]), "", None, " ".join(made[4] + passage[:30])]
    d = frame(spark, rows)
    got = {x.doc_id: x for x in substring_dedup.repeated_passages(d).collect()}
    assert set(got) == {1, 2} and all(x.source_id == 0 for x in got.values())
    assert (got[1].start_word, got[1].end_word, got[1].source_start, got[1].source_end) == (10, 80, 40, 110)
    assert got[2].end_word >= 68 and got[2].start_word <= 2
    left = {x.doc_id: x.text for x in substring_dedup.cut_repeats(d).collect()}
    assert left[1] == " ".join(made[1]) and left[0] == rows[0] and left[3] == rows[3] and left[5] is None and left[6] == rows[6]


def test_passages_with_parts_first_used_elsewhere(spark):
    r = random.Random(4)
    some = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    rows, want = [], {}
    for _ in range(60):
        p = some(60)
        rows += [" ".join(some(50) + p[:45] + some(50)), " ".join(some(50) + p + some(50)), " ".join(some(50) + p + some(50))]
        want[len(rows) - 1] = len(rows) - 2
    got = {(x.doc_id, x.source_id) for x in substring_dedup.repeated_passages(frame(spark, rows)).collect() if (x.start_word, x.end_word) == (50, 110)}
    assert got <= set(want.items()) | {(a - 1, a - 2) for a in want} and sum(x in got for x in want.items()) >= 50


def test_passages_of_repeated_lines(spark):
    r = random.Random(8)
    some = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    rows, want = [], {}
    for width in (1, 2, 3, 4, 6, 7, 9, 10, 12, 14, 15, 18, 25):
        line, times = some(width), -(-100 // width)
        rows += [" ".join(some(40) + line * times + some(40)), " ".join(some(40) + line * times + some(40)), " ".join(some(40) + line * 4 * times + some(40))]
        want |= {len(rows) - 2: (40, 40 + width * times), len(rows) - 1: (40, 40 + 4 * width * times)}
    held = {i: set() for i in range(len(rows))}
    for x in substring_dedup.repeated_passages(frame(spark, rows)).collect():
        held[x.doc_id] |= set(range(x.start_word, x.end_word))
    assert all(held[i] <= set(range(*want.get(i, (0, 0)))) for i in held)
    assert all(len(held[i]) >= 0.9 * (b - a) for i, (a, b) in want.items())


def test_passages_near_the_threshold(spark):
    r = random.Random(6)
    some = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    rows, want = [], {}
    for alike, every in ((80, 5), (85, 7), (90, 10)):
        for size in (60, 200):
            for _ in range(20):
                p = some(size)
                q = [w if i % every < every - 1 else "new" + w for i, w in enumerate(p)]
                rows += [" ".join(some(30) + p + some(30)), " ".join(some(30) + q + some(30))]
                want.setdefault((alike, size), {})[len(rows) - 1] = 0.9 * size
    held = {x.doc_id: x.end_word - x.start_word for x in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert all(sum(held.get(i, 0) >= n for i, n in cases.items()) >= 18 for cases in want.values())


def test_every_passage_of_a_chain_is_found(spark):
    r = random.Random(21)
    some = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    p, q = some(3000), some(3000)
    rows = [" ".join(p + some(2100) + q), " ".join(some(20) + p + some(2200) + q + some(20))]
    got = sorted((x.start_word, x.end_word) for x in substring_dedup.repeated_passages(frame(spark, rows)).collect())
    assert got == [(20, 3020), (5220, 8220)]


def test_passages_whose_parts_have_other_first_sources(spark):
    r = random.Random(22)
    some = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    rows, want = [], []
    for _ in range(40):
        x, y, z = some(40), some(40), some(20)
        rows += [" ".join(some(30) + t + some(30)) for t in (x, y, x + y, x + y)]
        want.append((len(rows) - 1, 30, 110))
        lines = [some(20) for _ in range(3)]
        rows += [" ".join(some(30) + t + some(30)) for t in (*lines, sum(lines, []), sum(lines, []), z)]
        want.append((len(rows) - 2, 30, 90))
    got = {(x.doc_id, x.start_word, x.end_word) for x in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert all(w in got for w in want)


def test_alignment_memory_is_bounded():
    r = np.random.default_rng(5)
    a, b = (r.integers(0, 1 << 62, n).astype(np.uint64) for n in (90_000, 80_000))
    b[:60], b[-60:] = a[:60], a[-60:]
    got = substring_dedup.align(a, b, [0, len(a) - 3], [0, len(b) - 3], 3, 50, 80)
    assert [(s, e) for s, e, *_ in got] == [(0, 60), (len(a) - 60, len(a))]


def test_runs_equal_brute_force():
    r = random.Random(2)
    for _ in range(200):
        hit = np.array([r.random() < 0.75 for _ in range(r.randrange(1, 40))])
        for s, e in substring_dedup.good_runs(hit, 5, 80):
            assert e - s >= 5 and 100 * hit[s:e].sum() >= 80 * (e - s)
        best = max(((e - s) for s in range(len(hit)) for e in range(s + 5, len(hit) + 1) if hit[s:e].all()), default=0)
        assert max((e - s for s, e in substring_dedup.good_runs(hit, 5, 80)), default=0) >= best


def test_quality(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = quality.quality_scores(d).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "good"), "doc_id").collect()
    wrong = [r for r in got if r.kept != (r.good == 1)]
    assert len(got) > 300 and len(wrong) <= 0.01 * len(got)
    kept = quality.keep_good(d.union(frame(spark, ["", None], 90_000).select(*d.columns)))
    assert kept.columns == d.columns and kept.filter("doc_id >= 90000").isEmpty()


def test_accuracies_are_estimated_from_agreement():
    r = np.random.default_rng(4)
    n, m = 40_000, len(quality.LABELLERS)
    fine = r.random(n) < 0.8
    alarm, find = r.uniform(0.01, 0.08, m), r.uniform(0.5, 0.9, m)
    votes = np.where(r.random((n, m)) < np.where(fine[:, None], alarm, find), quality.JUNK, quality.FINE)
    votes[r.random((n, m)) < 0.3] = quality.ABSTAIN
    code, counts = np.unique(votes @ 3 ** np.arange(m), return_counts=True)
    rates, posterior = quality.estimate(code, counts.astype(float))
    assert abs((counts @ posterior) / n - fine.mean()) < 0.01
    assert np.abs(rates[:, 1, quality.JUNK] - alarm).max() < 0.02 and np.abs(rates[:, 0, quality.JUNK] - find).max() < 0.04


def test_estimated_classes_on_the_corpus():
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    t, l = (pq.read_table(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    good = dict(zip(l.column("doc_id").to_pylist(), l.column("quality").to_pylist(), strict=True))
    code, back, counts = np.unique(quality.votes(quality.Shapes(pc.fill_null(t.column("text"), "").combine_chunks())) @ 3 ** np.arange(len(quality.LABELLERS)), return_inverse=True, return_counts=True)
    _, posterior = quality.estimate(code, counts.astype(float))
    pairs = [(p >= 0.5, good[i] == 1) for p, i in zip(posterior[back], t.column("doc_id").to_pylist(), strict=True) if i in good]
    assert sum(a == b for a, b in pairs) >= 0.98 * len(pairs)


def test_quality_sample_is_whole_and_travels_compactly(spark):
    import pyarrow as pa

    assert (quality.SAMPLE, quality.BUCKETS) == (6000, 1024)
    text = pa.array(["Some words, of a text that is neither long nor odd."] * 50)
    rows = next(quality._sampled(iter([pa.RecordBatch.from_arrays([text], ["text"])]))).column("x")
    assert all(np.array_equal(np.frombuffer(zlib.decompress(v.as_py()), np.float32), x) for v, x in zip(rows, quality.features(quality.Shapes(text)), strict=True))
    assert max(len(v.as_py()) for v in rows) < quality.BUCKETS


def test_languages(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = d.union(frame(spark, ["", None, "12 !"], 90_000).select(*d.columns))
    got = langid.identify(both).join(both.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.doc_id < 90_000]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert {r.lang_pred for r in got if r.doc_id >= 90_000} == {"und"}


def test_top_k_is_exact(spark):
    r = np.random.default_rng(1)
    x = [r.standard_normal(16).tolist() for _ in range(300)] + [None, [None] * 16, [float("nan")] * 16, [0.5] * 16, [0.5] * 16]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for row in topk.top_k(d, F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(row.query_id, []).append((row.rank, -row.score, row.vec_id))
    v = {i: np.floor(64 * np.float32(a).astype(float)).astype(int) for i, a in enumerate(x) if i not in (300, 301, 302)}
    for q in (i for i in v if i % 20 == 0):
        want = sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:7]
        assert [(s, i) for _, s, i in sorted(got[q])] == want


def test_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    both = pages.union(spark.createDataFrame([(10**6, None, None), (10**6 + 1, "u", ""), (10**6 + 2, "u", "<p <b>")], pages.schema))
    source = {r.page_id: r.html for r in pages.collect()}
    for row in html_extract.extract_pages(both).collect():
        assert row.n_chars == len(row.text)
        if row.page_id in source:
            inner = re.search("<article>(.*?)</article>", source[row.page_id], re.S)[1]
            parts = (" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner))
            assert row.text == "\n".join(p for p in parts if p)


def test_elements_without_end_tags_keep_the_rest_of_the_page():
    def got(page):
        return [b.text for b in html_extract.blocks(page)]

    assert got("<html><head><title>T</title><meta charset=x><body><header>H</header><p>one<p>two") == ["H", "one", "two"]
    assert got("<head><title>T</title><p>one</p><header>H</header><p>two</p>") == ["one", "H", "two"]
    assert got("<head><script>if (a</b) x</scripts></script></head><p>one") == ["one"]
    for name in ("object", "svg", "math", "iframe", "noscript", "template"):
        assert got(f"<article><p>one</p><{name}><p>two</p></article><p>three</p>") == ["one", "two", "three"], name
    assert got("<p>a <math><mi>x</mi></math> b <object>c</object></p>") == ["a x b c"]
    found = html_extract.blocks("<article><select><option>o</option><p>two</p></article>")
    assert [(b.text, html_extract.teacher(b)) for b in found] == [("o", 0), ("two", 1)]


def test_empty_tables(spark):
    e = empty(spark)
    frames = [exact_dedup.exact_groups(e), near_dedup.near_groups(e), packing.pack_documents(e, public_tokenizers.path("word_bpe_49k.json")), substring_dedup.repeated_passages(e), langid.identify(e), quality.quality_scores(e)]
    assert all(f.isEmpty() for f in frames)
