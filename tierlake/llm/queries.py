"""The operators' queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.llm import (byte_bpe, decontam, hard_negatives, langid, ngram_join, packing, prefix_trie, secret_scan,
                          sharding, token_counts, topk, url_rules, warc)
from tierlake.llm.shipping import ship
from tierlake.session import scratch_path
from tierlake.sources.tables import table_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark, sf_dir, table):
    ship(spark)
    return spark.read.parquet(table_path(sf_dir, table))


def op1_sharding(spark, sf_dir):
    return sharding.shard_documents(spark, _read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_url_filters(spark, sf_dir):
    return url_rules.filter_urls(_read(spark, sf_dir, "pages").select("page_id", "url")) \
        .select("page_id", "host", "path", "rule", "verdict")


def op3_packing(spark, sf_dir):
    return packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"),
                        tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op4_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    sample = langid.sample_texts(docs.where(~F.col("held_out") & F.col("lang").isNotNull()), "doc_id", "text", "lang")
    return langid.identify(docs.select("doc_id", "held_out", "text"), sample) \
        .select("doc_id", "held_out", "lang_pred", "score")


def op5_warc(spark, sf_dir):
    path = scratch_path(spark, "llm", "warc")
    warc.write_archive(_read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(spark, _read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_read(spark, sf_dir, "documents").select("doc_id", "text"),
                                     tokenizer_path("piece_bpe_32k.model"))


def op8_decontamination(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.find_matches(docs, _read(spark, sf_dir, "benchmark")))


def op9_secret_scans(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.find_secrets(spark, docs))


def op10_topk(spark, sf_dir):
    vectors = topk.quantised(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(spark, vectors, F.col("id") % 50 == 0)


def op11_prefix_trie(spark, sf_dir):
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    paths = prefix_trie.as_paths(prefix_trie.rebuilt(prefix_trie.sequences(turns)))
    return prefix_trie.prefix_trie(spark, paths)


def op12_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return byte_bpe.round_trip(_read(spark, sf_dir, "documents").select("doc_id", "text"),
                               tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark, hard_negatives.quantised(_read(spark, sf_dir, "embeddings")))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_url_filters, op3_packing, op4_language_id, op5_warc, op6_ngram_join, op7_token_counts,
    op8_decontamination, op9_secret_scans, op10_topk, op11_prefix_trie, op12_byte_bpe, op13_hard_negatives, pipeline)}

ORACLE = {
    "op2_url_filters": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        cut AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, rest FROM parts),
        placed AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path
            FROM cut),
        rules(rule, h, p, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                                        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
        ruled AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
            FROM placed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY page_id)
        SELECT page_id, host, path, rule,
               coalesce(v, CASE WHEN host <> '' AND regexp_matches(
                   translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '(^|[^0-9a-z])(cheap[-_.]pills|casino[-_.]win|spam[-_.]farm|free[-_.]bets|ads[-_.]track|adult[-_.]x)([^0-9a-z]|$)')
                   THEN 'block' ELSE 'allow' END) AS verdict
        FROM placed LEFT JOIN ruled USING (page_id)""",
    "op5_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        h AS (SELECT page_id, payload, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS least FROM p),
        w AS (SELECT *, [('0x' || substr(hex, CAST(k * 5 + 1 AS INT), 5))::BIGINT for k in range(0, 8)] AS five
              FROM h)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((five[k // 4 + 1] >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31 AS INT) + 1, 1)
                   for k in range(0, 32)], '') AS payload_digest,
               CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
        FROM w""",
    "op10_topk": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r),
        t AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r) AS rank FROM s)
        SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM t WHERE rank <= 5""",
    "op11_prefix_trie": r"""
        WITH seq AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        h AS (
            SELECT conv_id, s, xor(list_reduce(
                list_prepend(4294967295, [ascii(c)::BIGINT for c in string_split(CAST(conv_id AS VARCHAR), '')]),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                         lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
            FROM seq),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS p
            FROM h c LEFT JOIN h b ON b.conv_id = c.conv_id - c.conv_id % 20),
        nodes AS (
            SELECT p[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n,
                   string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(p) = d) AS ends
            FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt) GROUP BY 1, 2),
        kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS c FROM nodes WHERE d > 0 GROUP BY 1, 2),
        own AS (
            SELECT nodes.*, coalesce(c, 0) AS c,
                   CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')) END AS saved
            FROM nodes LEFT JOIN kids USING (k, d)),
        below AS (
            SELECT k[1:a] AS k, a AS d, sum(CASE WHEN c = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
            FROM (SELECT k, c, saved, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1, 2)
        SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(o.n AS BIGINT) AS n_convs,
               CAST(o.c AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
        FROM own o JOIN below b USING (k, d) LEFT JOIN nodes u ON u.d = o.d - 1 AND u.k = o.k[1:o.d - 1]""",
    "op13_hard_negatives": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.r AS qr, q.vec_id AS anchor_id, q.label = c.label AS alike, c.r, c.vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r),
        p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r) <= 5),
        n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
                   s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.qr, p.r ORDER BY s.score DESC, s.vec_id, s.r) AS rank
            FROM p JOIN s ON s.qr = p.qr AND NOT s.alike
                 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 3""",
    "op8_decontamination": r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        iw AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
            FROM (SELECT item_id, w, unnest(range(1, CAST(greatest(len(w) - 9, 1) AS BIGINT) + 1)) AS p FROM iw WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
            SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
            FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 1 AS BIGINT) + 1)) AS p FROM dw, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (n, k)),
        words AS (SELECT doc_id, count(DISTINCT x) AS n_hit
                  FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
