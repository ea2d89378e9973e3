"""The numbered queries and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_tree import round_trip
from .collocations import collocations
from .common import stage_path, table
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .html_extract import extract_pages
from .langid import identify
from .near_dedup import near_groups
from .packing import pack_documents
from .quality import quality_scores
from .substring_dedup import repeated_passages
from .token_store import read_summary, write_store
from .topk import top_k
from .whitening import whiten


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_summary(spark, path)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), k=3, percent=85, bands=56, rows=8)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"))
    # null where the exact sum of squares leaves 64 bits
    return out.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_output": token_output,
        "op2_html_extraction": html_extraction,
        "op3_byte_bpe": byte_bpe,
        "op4_exact_topk": exact_topk,
        "op5_quality": quality,
        "op6_near_dedup": near_dedup,
        "op7_packing": packing,
        "op8_substring_dedup": substring_dedup,
        "op9_language": language,
        "op10_exact_dedup": exact_dedup,
        "op11_embedding_whitening": embedding_whitening,
        "op12_decontamination": decontamination,
        "op13_collocations": phrase_collocations,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_topk": """
            WITH v AS (
              SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
              FROM embeddings
              WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
            s AS (
              SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
              FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op12_decontamination": f"""
            WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
            win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
              FROM (SELECT *, unnest(range(1, CAST(greatest(len(w) - 8, 2) AS BIGINT))) AS i FROM iw WHERE len(w) > 0) t),
            dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
            pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
              FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM dw, (SELECT DISTINCT n FROM win) k WHERE len(w) >= n) t),
            hit AS (SELECT doc_id, i, pos.n, item_id FROM pos JOIN win ON pos.n = win.n AND pos.s = win.s),
            words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) t GROUP BY doc_id),
            items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) t GROUP BY doc_id)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
                   sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
            FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
        "op13_collocations": r"""
            WITH p AS (SELECT lang, row_number() OVER () AS id, s FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s FROM documents) t),
            w AS (SELECT lang, id, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
            g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
              FROM (SELECT lang, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM w, (VALUES (1), (2), (3)) k(m) WHERE len(w) >= m) t GROUP BY ALL),
            c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM g WHERE m > 1 AND f >= 10),
            cuts AS (SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
              FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
              JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
            best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS b FROM cuts),
            inner_ AS (SELECT lang, phrase, max(a) AS longer FROM (
                SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE m = 3) t GROUP BY lang, phrase),
            kept AS (SELECT b.lang, b.phrase, a, l, r, score FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase WHERE b.b = 1 AND (longer IS NULL OR 100 * longer < 50 * a)),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
            SELECT k.lang, rank, phrase, a, l, r, n, score FROM ranked k JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang) t ON t.lang = k.lang WHERE rank <= 2000""",
    }
