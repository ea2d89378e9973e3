"""The pipeline's stages in turn, each against a brute-force version on its own input, and odd inputs of every operator."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from test_operators import SCHEMA, SF, brute, empty, frame
from voxframe.llm import bpe_tree, exact_dedup, html_extract, langid, near_dedup, packing, quality, substring_dedup, token_store, topk
from voxframe.llm.common import lookup, stage_path, staged

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TIK = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words_of(text):
    return re.findall("[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows_of(texts, n=50):
    """First document of every run of n words."""
    first = {}
    for i in sorted(texts):
        w = words_of(texts[i])
        for j in range(len(w) - n + 1):
            first.setdefault(tuple(w[j : j + n]), i)
    return first


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    docs, held = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF), name)
        held.append((name, docs.columns, [r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()]))
        docs = out
    return {name: (columns, before, after) for name, columns, before, after in held}


def test_every_stage_but_the_last_returns_the_columns_of_documents(stages):
    names = list(stages)
    assert names == ["quality", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    assert all(list(after[0]) == columns for name, (columns, _, after) in stages.items() if name != "packing")


def test_quality_stage_keeps_rows_as_they_are(stages):
    _, before, after = stages["quality"]
    by = {r["doc_id"]: r for r in before}
    assert 0.6 * len(before) < len(after) <= len(before) and all(by[r["doc_id"]] == r for r in after)


def test_exact_stage_keeps_the_largest_id_of_each_text(stages):
    _, before, after = stages["exact_dedup"]
    last = {}
    for r in before:
        last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
    assert sorted(r["doc_id"] for r in after) == sorted(last.values())


def test_near_stage_keeps_one_of_each_group(stages):
    _, before, after = stages["near_dedup"]
    want = brute({r["doc_id"]: r["text"] or "" for r in before}, 5, 80)
    assert {r["doc_id"] for r in after} == {i for i, (_, root) in want.items() if i == root}


def test_substring_stage_cuts_every_repeated_run_and_nothing_clean(stages):
    _, before, after = stages["substring_dedup"]
    texts, left = {r["doc_id"]: r["text"] or "" for r in before}, {r["doc_id"]: r["text"] or "" for r in after}
    first, shared = windows_of(texts), windows_of(texts, 8)
    short = {}
    for i, t in texts.items():
        w = words_of(t)
        for j in range(len(w) - 7):
            short.setdefault(tuple(w[j : j + 8]), set()).add(i)
    for i, t in left.items():
        w = words_of(t)
        assert not any(first.get(tuple(w[j : j + 50]), i) < i for j in range(len(w) - 49))
    for i, t in texts.items():
        w = words_of(t)
        if all(len(short[tuple(w[j : j + 8])]) == 1 for j in range(len(w) - 7)):
            assert left[i] == t
    assert shared and all(r["n_chars"] == len(r["text"]) for r in after if left[r["doc_id"]] != texts[r["doc_id"]])


def test_packing_stage_holds_every_id_once(stages):
    _, before, after = stages["packing"]
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    total = {r["doc_id"]: len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before}
    held = {}
    for r in after:
        held.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert held.keys() == total.keys()
    for i, pieces in held.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == total[i]


def test_pipeline_query_gives_the_last_stage(spark, stages):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() == len(stages["packing"][2])


def odd_ids(spark):
    """Null and repeated ids, null texts, copies, and columns whose names clash with those that operators use."""
    t = "one two three four five six seven eight nine ten eleven twelve. "
    rows = [(None, t * 9), (None, t * 9), (None, "other words here"), (5, t * 9), (5, t * 9), (5, None), (6, ""), (7, None), (8, t * 9 + "tail"), (None, None)]
    return spark.createDataFrame([(i, x, "en", "s", 1, 2, 3, "b") for i, x in rows], SCHEMA)


def test_null_and_repeated_ids(spark):
    d = odd_ids(spark)
    n = d.count()
    e = exact_dedup.exact_groups(d).collect()
    assert len(e) == n and {r.keep_id for r in e if r.group_size == 4} == {5, 7}
    g = near_dedup.near_groups(d, k=3, percent=85).collect()
    assert len(g) == n and {r.component_id for r in g if r.n_shingles > 3} == {5}
    assert near_dedup.drop_near_duplicates(d).count() == n - 1  # 8 is near 5; null ids stay
    assert langid.identify(d).count() == quality.quality_scores(d).count() == n
    path = stage_path(spark, "odd-store")
    token_store.write_store(d, path, BYTES)
    s = token_store.read_summary(spark, path).collect()
    assert len(s) == n and all(r.verified for r in s) and sum(r.n_tokens for r in s) == max(r.start + r.n_tokens for r in s)
    assert bpe_tree.round_trip(d, TIK, public_tokenizers.PATTERN).count() == n
    assert packing.pack_documents(d, WORDS).select(F.sum("length")).first()[0] > 0
    p = substring_dedup.repeated_passages(d).collect()
    assert {(r.doc_id, r.source_id) for r in p} == {(8, 5)}
    assert substring_dedup.cut_repeats(d).count() >= n - 1
    assert quality.keep_good(d).columns == d.columns


def test_changed_files_are_found(spark):
    d = frame(spark, ["some words " * 400, "other words " * 300, ""])
    path = stage_path(spark, "store")
    token_store.write_store(d, path, BYTES)
    assert token_store.verify_manifest(spark, path)
    r = spark.read.parquet(f"{path}/recipes")
    bad = stage_path(spark, "store")
    for part in ("parts", "manifest"):
        spark.read.parquet(f"{path}/{part}").write.parquet(f"{bad}/{part}")
    r.withColumn("ids_crc32", F.when(F.col("doc_id") == 1, 7).otherwise(F.col("ids_crc32"))).write.parquet(f"{bad}/recipes")
    assert not token_store.verify_manifest(spark, bad)


def test_empty_tables_of_the_first_four(spark):
    e = empty(spark)
    path = stage_path(spark, "empty-store")
    token_store.write_store(e, path, BYTES)
    assert token_store.read_summary(spark, path).isEmpty()
    assert bpe_tree.round_trip(e, TIK, public_tokenizers.PATTERN).isEmpty()
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).isEmpty()
    assert exact_dedup.deduplicate(e).isEmpty() and quality.keep_good(e).isEmpty() and near_dedup.drop_near_duplicates(e).isEmpty() and substring_dedup.cut_repeats(e).isEmpty()


def test_vectors_of_several_lengths(spark):
    r = np.random.default_rng(3)
    x = [r.standard_normal(8 if i % 3 else 5).tolist() for i in range(120)]
    d = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = {}
    for row in topk.top_k(d, F.col("vec_id") % 20 == 0, k=4).collect():
        got.setdefault(row.query_id, []).append((row.rank, row.score, row.vec_id))
    v = {i: np.floor(64 * np.array(a)).astype(int) for i, a in enumerate(x)}
    for q in range(0, 120, 20):
        want = sorted((-int(v[q] @ v[i]), i) for i in v if i != q and len(v[i]) == len(v[q]))[:4]
        assert [(-s, i) for _, s, i in sorted(got[q])] == want


def test_bounds_leave_out_most_of_a_clustered_table(spark):
    r = np.random.default_rng(8)
    centres = r.standard_normal((24, 16)) * 4
    x = np.concatenate([c + 0.05 * r.standard_normal((60, 16)) for c in centres])
    learned = np.floor(64 * x)
    pivots = topk.choose_pivots(learned)
    index = topk.Index(pivots, np.array([0.0]), "<i2")
    pivot, ring, dist = index.keys(learned)
    norm = np.sqrt((learned**2).sum(axis=1))
    annuli = topk.Annuli([{"pivot": p, "ring": 0, "n": int((pivot == p).sum()), "low": dist[pivot == p].min(), "high": dist[pivot == p].max(), "norm": norm[pivot == p].max()} for p in np.unique(pivot)])
    least = np.sort(learned @ learned.T, axis=1)[:, -21]
    read = (annuli.bounds(learned, pivots) >= least[:, None]) @ annuli.n
    assert read.mean() < 0.35 * len(x)
    score = learned @ learned.T
    for j, p in enumerate(annuli.pivot):
        assert (annuli.bounds(learned, pivots)[:, j] >= score[:, pivot == p].max(axis=1)).all()


def test_signatures_of_pairs_at_the_threshold_share_a_bucket():
    r, missed, n = np.random.default_rng(6), 0, 0
    for k3, signer, percent in ((True, near_dedup.Signer(56, 8), 85), (False, near_dedup.Signer(64, 7), 80)):
        for size in (7, 12, 20, 40, 80, 160, 400):
            for _ in range(120):
                common = r.integers(0, 1 << 63, size).astype(np.uint64)
                more = int(size * (100 - percent) / percent)
                a, b = common, np.concatenate([common, r.integers(0, 1 << 63, more).astype(np.uint64)])
                assert 100 * len(a) >= percent * len(b)
                n += 1
                missed += not np.intersect1d(signer(np.unique(a)), signer(np.unique(b))).size
    assert missed == 0 and n == 1680


def test_counts_of_many_short_texts_equal_brute_force():
    r = random.Random(1)
    texts = ["".join(r.choice("abc é.") for _ in range(r.randrange(9))) for _ in range(1000)]
    row, bucket, n = langid.gram_counts(texts)
    assert (np.diff(row) >= 0).all() and row.max() < 1000
    total = np.bincount(row, n, 1000)
    for i, t in enumerate(texts):
        flat = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in t.lower()))
        assert total[i] == sum(max(0, len(flat) - k + 1) for k in (1, 2, 3))
    model = langid.Model(["x", "y"], np.log([0.4, 0.6]), np.log(np.random.default_rng(2).uniform(0.1, 1, (2, langid.BUCKETS))).astype(np.float32))
    dense = np.zeros((1000, langid.BUCKETS))
    np.add.at(dense, (row, bucket), n)
    assert np.allclose(langid.scores(model, texts), dense @ model.logs.T.astype(float) + model.prior)


def test_scripts_and_images_split_no_word():
    got = [b.text for b in html_extract.blocks("<p>foo<script>1</script>bar x<img src=a>y a<br>b <style>p</style>c</p>")]
    assert got == ["foobar xy a b c"]


def test_articles_without_semantic_containers(spark):
    """Layouts that the composed pages don't have, labelled by hand: divisions only, a table, bare paragraphs."""
    body = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect()]
    texts = [b.text for p in body for b in html_extract.blocks(p) if len(b.text) > 150][:60]
    model = html_extract.train(body)
    right = total = 0
    for i in range(0, 54, 3):
        three = texts[i : i + 3]
        for page in (
            f"<div class=menu><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></div><div class=entry-content>{''.join(f'<p>{t}</p>' for t in three)}</div><div class=footer>All rights</div>",
            f"<div id=nav><a href=x>One</a></div><div class=post>{''.join(f'<div>{t}</div>' for t in three)}</div><div class='sidebar widget'><h3>More</h3><a href=q>Link</a></div>",
        ):
            found = html_extract.blocks(page)
            keep = html_extract.label(model, [found])[0]
            right += sum(bool(k) == (b.text in three) for b, k in zip(found, keep, strict=True))
            total += len(found)
    assert right >= 0.9 * total


def test_lookup_of_hot_keys(spark):
    rows = spark.createDataFrame([(1, i) for i in range(300)] + [(2, 7), (None, 8), (3, 9)], "k int, i int")
    held = staged(spark.createDataFrame([(1, "a", 300), (2, "b", 1), (4, "c", 1)], "k int, v string, n long"), "held")
    left = {(r.k, r.i): r.v for r in lookup(rows, held, ["k"], "n", ["i"], "left", share=10).collect()}
    assert len(left) == 303 and left[(1, 5)] == "a" and left[(2, 7)] == "b" and left[(3, 9)] is None and left[(None, 8)] is None
    assert lookup(rows, held, ["k"], "n", ["i"], share=10).count() == 301
