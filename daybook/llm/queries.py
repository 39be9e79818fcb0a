"""The package's queries over the driver's tables, and the SQL that DuckDB can hold some of them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import table
from daybook.session import spread


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op1_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.warc import round_trip

    return round_trip(spread(table(spark, sf_dir, "pages")))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.secret_ledger import digest_columns, scan_in_runs

    return digest_columns(scan_in_runs(spread(table(spark, sf_dir, "documents")), path_col="doc_id"))


def op3_balanced_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.balanced_sharding import assign

    return assign(spread(table(spark, sf_dir, "documents")), shards=40).drop("group")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.token_counts import token_counts

    return token_counts(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("piece_bpe_32k.model"))


def op6_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.fm_quality import fit, scored

    docs = spread(table(spark, sf_dir, "documents"))
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))


def op7_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.vector_packing import pack

    return pack(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"), tokens=2048)


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.language_mixture import identify

    return identify(spread(table(spark, sf_dir, "documents"))).select(
        "doc_id", "held_out", "lang_pred", "score", F.to_json("languages").alias("languages")
    )


def op9_hamming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.hamming_dedup import near_duplicates

    return near_duplicates(spread(table(spark, sf_dir, "documents")))


def op10_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.decontaminate import decontaminate, digest_columns

    return digest_columns(decontaminate(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark")))


def op11_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.piece_encoding import digests

    return digests(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("piece_bpe_32k.model"))


def op12_summa_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.summa_negatives import mine

    return mine(table(spark, sf_dir, "embeddings"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.filter_audit import audit

    return audit(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_dictionary_warc": op1_dictionary_warc,
    "op2_secret_ledger": op2_secret_ledger,
    "op3_balanced_propagation": op3_balanced_propagation,
    "op4_token_counts": op4_token_counts,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_factorisation_machine": op6_factorisation_machine,
    "op7_vector_best_fit": op7_vector_best_fit,
    "op8_language_mixture": op8_language_mixture,
    "op9_hamming_dedup": op9_hamming_dedup,
    "op10_prefix_decontamination": op10_prefix_decontamination,
    "op11_piece_backtracking": op11_piece_backtracking,
    "op12_summa_negatives": op12_summa_negatives,
    "op13_filter_interactions": op13_filter_interactions,
}

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

#: None for those that positions of matches, learned models or tokenizers keep out of SQL; tests have brute force.
ORACLE_SQL = {
    "op1_dictionary_warc": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS sha1 FROM p),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY sha1, payload_bytes) AS holder FROM h)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(sha1 || '00', (5 * i) // 4 + 1, 3))::INT >> (7 - (5 * i) % 4)::INT) & 31) + 1, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> holder THEN holder END AS refers_to
        FROM g
    """,
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        d AS (SELECT doc_id, length(text) AS n,
                     sha256(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM t)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept,
               text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
    "op9_hamming_dedup": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, i, i + 4) END AS shingle
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
        links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, links.b FROM r JOIN links ON links.a = r.c),
        c AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
    """,
    "op10_prefix_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, list_slice(w, i, i + least(len(w), 10) - 1) AS win
                 FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
        spots AS (SELECT doc_id, i, l, list_slice(w, i, i + l - 1) AS win
               FROM (SELECT doc_id, w, l, unnest(range(1, greatest(len(w) - l + 2, 1))) AS i FROM d, (SELECT DISTINCT l FROM wins))),
        hit AS (SELECT doc_id, i, l, item_id FROM spots JOIN wins USING (l, win)),
        n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
        f AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
              FROM hit GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN f USING (doc_id)
    """,
    "op12_summa_negatives": r"""
        WITH v AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
        n AS (SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS rank, s.b AS negative_id,
                     p.score AS positive_score, s.score AS negative_score
              FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT * FROM n WHERE rank <= 10
    """,
    "op13_filter_interactions": r"""
        WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        f AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                     || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
                     || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                     || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM w),
        g AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a JOIN x b ON b.x <> a.x JOIN x c ON c.x NOT IN (a.x, b.x)
              JOIN x d ON d.x NOT IN (a.x, b.x, c.x) JOIN x e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
        s AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
        k AS (SELECT *, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier FROM s),
        h AS (SELECT *, contains(fails, filter) AS hit, len(regexp_extract_all(earlier, '[' || fails || '_]')) = 0 AS here FROM g, k),
        r AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (here AND NOT hit), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (here AND hit), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (hit AND NOT here), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = filter), 0)::BIGINT AS unique_fails,
                     coalesce(sum(good) FILTER (here AND hit), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (here AND hit), 0)::BIGINT AS toxic_lost
              FROM h GROUP BY part, filter_order, step, filter)
        SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r
    """,
}
