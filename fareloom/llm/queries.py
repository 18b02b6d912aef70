"""The operators bound to the tables, with the parameters of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fareloom.llm import (
    fingerprints,
    licenses,
    merkle,
    minhash,
    mixing,
    ngram_jaccard,
    packing,
    quality,
    ranked_search,
    token_counts,
    url_filter,
    vector_graph,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op1_url_filters(spark, d):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, d, "pages"), rules)


@query
def op2_license_scans(spark, d):
    return licenses.license_scan(_table(spark, d, "documents"))


@query
def op3_quality_classifier(spark, d):
    return quality.quality_scores(_table(spark, d, "documents"), _table(spark, d, "labels"))


@query
def op4_best_fit_packing(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return packing.best_fit_packing(docs, public_tokenizers.path(TOKENIZER))


@query
def op5_document_fingerprints(spark, d):
    return fingerprints.fingerprints(_table(spark, d, "documents"))


@query
def op6_mixing_sources(spark, d):
    return mixing.mix_sizes(_table(spark, d, "documents").select("doc_id", "text", "source"))


@query
def op7_ngram_jaccard_join(spark, d):
    return ngram_jaccard.jaccard_components(_table(spark, d, "documents"))


@query
def op8_approximate_nearest_neighbours(spark, d):
    return vector_graph.nearest(_table(spark, d, "embeddings"))


@query
def op9_warc(spark, d):
    records = warc.archive_round_trip(_table(spark, d, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_token_counts(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path(TOKENIZER))


@query
def op11_merkle_manifest(spark, d):
    return merkle.manifest(_table(spark, d, "documents"))


@query
def op12_ranked_search(spark, d):
    return ranked_search.ranked_search(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


@query
def op13_minhash_near_dedup(spark, d):
    return minhash.near_duplicates(_table(spark, d, "documents"))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

SQL["op1_url_filters"] = rf"""
WITH rules(h, p, v) AS (VALUES {_RULES_SQL}),
urls AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
judged AS (
    SELECT page_id, host, path, (
        SELECT max(struct_pack(len := length(h || p), rule := h || p, verdict := v)) FROM rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    ) AS best
    FROM urls
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

# Base32 of the digest: every five hex digits are twenty bits, hence four letters.
SQL["op9_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
digests AS (
    SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)
    ), 'string_agg', '') AS payload_digest
    FROM payloads
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _merkle_sql(levels: int = 8, over: int = 3) -> str:
    """Trees of up to 8^levels leaves over up to 8^over groups, level by level.

    Every level has its runs as lists; a leaf's proof and folded hash are carried up through them.
    The crc is computed bit by bit.
    """
    field = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    crc = """xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
        lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))
    ), 4294967295)"""
    parts = [
        f"""hashed AS (
    SELECT row_number() OVER () AS id, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
        {digest("text")} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {digest(_LOWERED)} ELSE {digest("text")} END AS folded
    FROM documents
)""",
        """placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY tree) AS n
    FROM hashed
)""",
        "t0 AS (SELECT tree, idx, n, leaf AS h FROM placed)",
        "p0 AS (SELECT id, doc_id, tree, leaf, idx, n, folded, '' AS proof FROM placed)",
    ]

    def level(t: str, p: str, k: int, keep: str) -> list[str]:
        siblings = "array_to_string(run[1:idx % 8], ''), array_to_string(run[idx % 8 + 2:], '')"
        return [
            f"{t}r{k} AS (SELECT tree, idx // 8 AS place, n, list(h ORDER BY idx) AS run FROM {t}{k} GROUP BY tree, idx // 8, n)",
            f"""{t}{k + 1} AS (
    SELECT tree, place AS idx, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM {t}r{k}
)""",
            f"""{p}s{k} AS (
    SELECT {keep}, p.tree, p.idx, p.n, folded, proof, CASE WHEN p.n > 1 THEN [{siblings}] ELSE ['', ''] END AS s
    FROM {p}{k} p JOIN {t}r{k} r ON p.tree = r.tree AND p.idx // 8 = r.place
)""",
            f"""{p}{k + 1} AS (
    SELECT {keep}, tree, idx // 8 AS idx, (n + 7) // 8 AS n, proof || s[1] || s[2] AS proof,
        CASE WHEN n > 1 THEN sha256(s[1] || folded || s[2]) ELSE folded END AS folded
    FROM {p}s{k}
)""",
        ]

    for k in range(levels):
        parts += level("t", "p", k, "id, doc_id, leaf")
    parts += [
        f"g0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, h FROM t{levels})",
        f"""q0 AS (
    SELECT id, doc_id, leaf, g.h AS subroot, 0 AS tree, p.tree AS idx, g.n, folded, proof
    FROM p{levels} p JOIN g0 g ON p.tree = g.idx
)""",
    ]
    for k in range(over):
        parts += level("g", "q", k, "id, doc_id, leaf, subroot")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT doc_id, leaf, subroot, g.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = g.h AS verified
FROM q{over} q JOIN g{over} g ON q.tree = g.tree
"""
    )


SQL["op11_merkle_manifest"] = _merkle_sql()

SQL["op12_ranked_search"] = rf"""
WITH doc_terms AS (
    SELECT id, doc_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS id, * FROM documents)
),
freq AS (SELECT id, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
sizes AS (SELECT id, sum(tf)::BIGINT AS n FROM freq GROUP BY id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
    FROM freq, total GROUP BY term, docs
),
item_terms AS (
    SELECT id, item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS id, * FROM benchmark)
),
wanted AS (SELECT id AS item, item_id, term, count(*) AS times FROM item_terms GROUP BY ALL),
scored AS (
    SELECT item, item_id, f.doc_id, f.id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
    FROM wanted JOIN freq f USING (term) JOIN weights USING (term) JOIN sizes s ON s.id = f.id, total
    GROUP BY ALL
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL["op13_minhash_near_dedup"] = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS own
    FROM worded
),
shingles AS (SELECT doc_id, len(own) AS n, unnest(own) AS shingle FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY ALL
),
links AS (SELECT a, b FROM common WHERE 100 * shared >= 80 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT DISTINCT a AS doc_id, a AS other FROM edges
    UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a
),
least_id AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT s.doc_id, len(own)::BIGINT AS n_shingles, coalesce(other, s.doc_id) AS component_id,
    coalesce(other, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN least_id l ON s.doc_id = l.doc_id
"""
