"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nightfolio.llm import (
    blob_ledger,
    decontaminate,
    embedding_lsh,
    filter_audit,
    jaccard_join,
    languages,
    masked_lm,
    packing,
    pii,
    pivot_search,
    transcripts,
    treap_search,
    warc,
)
from nightfolio.llm.common import scratch_path, tuned


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_pii(spark, sf):
    return pii.find(_table(spark, sf, "documents"))


def op2_cost_packing(spark, sf):
    return packing.packed(_table(spark, sf, "documents"))


def op3_spaced_seeds(spark, sf):
    return decontaminate.overlaps(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op4_crf_language(spark, sf):
    return languages.identify(_table(spark, sf, "documents"))


def op5_blob_ledger(spark, sf):
    """Scans into a new ledger, so every blob is unseen."""
    return blob_ledger.report(_table(spark, sf, "documents"), scratch_path(spark, "ledger"))


def op6_hmm_transcripts(spark, sf):
    return transcripts.recovered(_table(spark, sf, "conversations"))


def op7_jaccard_join(spark, sf):
    return jaccard_join.join_components(_table(spark, sf, "documents"))


def op8_masked_lm(spark, sf):
    return masked_lm.score(_table(spark, sf, "documents"))


def op9_cross_polytope(spark, sf):
    return embedding_lsh.near_duplicates(_table(spark, sf, "embeddings"))


def op10_dictionary_warc(spark, sf):
    return warc.round_trip(_table(spark, sf, "pages"))


def op11_filter_audit(spark, sf):
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op12_pivot_search(spark, sf):
    return pivot_search.search(_table(spark, sf, "embeddings"))


def op13_treap_search(spark, sf):
    return treap_search.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}

ORACLE_SQL: dict[str, str] = {
    "op10_dictionary_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
            FROM pages
        ), m AS (
            SELECT html, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY html
        )
        SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
            CASE WHEN m.top > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN m.top > p.page_id THEN m.top END AS refers_to
        FROM p LEFT JOIN m ON p.html = m.html
    """,
    "op11_filter_audit": """
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
                min(doc_id) OVER (PARTITION BY t) AS first
            FROM d
        ), l AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
            FROM labels GROUP BY doc_id
        ), f AS (
            SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
                CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN w.doc_id > w.first THEN 'E' ELSE '' END AS failed
            FROM w LEFT JOIN l ON w.doc_id = l.doc_id
        ), c AS (
            SELECT part, good, toxic, failed, count(*) AS n FROM f GROUP BY ALL
        ), k AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM k a, k b, k c, k d, k e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), s AS (
            SELECT filter_order, step, filter_order[step] AS own, filter_order[:step - 1] AS before
            FROM o, (SELECT unnest(range(1, 6)) AS step)
        ), r AS (
            SELECT c.*, s.filter_order, s.step, s.own, contains(failed, own) AS fails,
                failed <> '' AND regexp_matches(before, '[' || failed || '0]') AS gone
            FROM c, s
        ), t AS (
            SELECT part, filter_order, step, own,
                sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
                sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
            FROM r GROUP BY ALL
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
            CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
            CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
            CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM t
    """,
    "op12_pivot_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE len(embedding) > 0 AND NOT list_contains(
                list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
        ), p AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM p
        )
        SELECT * FROM r WHERE rank <= 20
    """,
    "op13_treap_search": """
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
            FROM documents
        ), i AS (
            SELECT item_id, unnest(list_distinct(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS t
            FROM benchmark
        ), s AS (
            SELECT count(*) AS docs, sum(len(ts)) AS total FROM d WHERE len(ts) > 0
        ), p AS (
            SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(ts) AS t FROM d) GROUP BY k, t
        ), w AS (
            SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM p, s GROUP BY t, docs
        ), m AS (
            SELECT k, doc_id, CAST(50 + (50 * len(ts) * docs) // total AS BIGINT) AS m FROM d, s
        ), scored AS (
            SELECT item_id, k, doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM i JOIN p USING (t) JOIN w USING (t) JOIN m USING (k)
            GROUP BY item_id, k, doc_id
        ), r AS (
            SELECT item_id, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT * FROM r WHERE rank <= 50
    """,
}
