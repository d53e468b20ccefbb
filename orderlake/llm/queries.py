"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import chat, decontaminate, exact_dedup, html_extract, jaccard_join, license_scan, lm_scoring, packing, repair, sharding, toxicity, warc, whitening
from orderlake.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"))


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.sql("SELECT -7L AS conv_id, t AS turn, r AS role, x AS text FROM VALUES (0L, 'user', :x), (1L, 'assistant', :x) AS v(t, r, x)", {"x": said})
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.budgeted_windows(turns))


def op4_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.content_sort(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_path())


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.with_empty(repair.repair(repair.damage(turns)), turns)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    return white.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"), lm_scoring.tokenizer_path())


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_warc_index, op3_chat_windows, op4_vector_shards, op5_content_sort, op6_main_text,
        op7_jaccard_join, op8_license_scan, op9_packing, op10_toxic_segments, op11_conversation_repair, op12_whitening,
        op13_lm_scoring,
    )
}

ORACLE = {
    "op2_warc_index": """
        WITH d AS (
          SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex,
            max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages)
        SELECT page_id, url, strlen(h) AS payload_bytes,
          array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
          CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> best THEN best END AS refers_to
        FROM d""",
    "op3_chat_windows": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        u AS (
          SELECT *, row_number() OVER w AS n, len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) + 2 AS tokens,
            15 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS chars
          FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        v AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) - tokens AS BIGINT) AS pos FROM u),
        r AS (
          SELECT *, n = 1 AND role = 'system' AS is_system,
            1024 - max(CASE WHEN n = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS room FROM v),
        x AS (SELECT *, (pos // stride) * 2 + CASE WHEN tokens > stride THEN 1 ELSE 0 END AS span
          FROM (SELECT *, greatest(CAST(floor((room - 256) / 2) AS BIGINT), 1) AS stride FROM r)),
        f AS (SELECT conv_id, n, pos, span, least(256, room - tokens) AS past, lag(span) OVER (PARTITION BY conv_id ORDER BY n) AS span_before FROM x),
        repeats AS (
          SELECT f.conv_id, sum(x.chars) AS chars FROM f JOIN x ON x.conv_id = f.conv_id
            AND (x.is_system OR x.pos BETWEEN f.pos - f.past AND f.pos - 1)
          WHERE f.n > 1 AND f.span <> f.span_before AND x.n < f.n GROUP BY f.conv_id)
        SELECT t.conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
          coalesce(length(string_agg(text, '') FILTER (role = 'assistant')), 0) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(t.chars) + coalesce(any_value(repeats.chars), 0) AS BIGINT) AS formatted_chars
        FROM x AS t LEFT JOIN repeats ON repeats.conv_id = t.conv_id GROUP BY t.conv_id""",
    "op5_content_sort": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
            regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        g AS (
          SELECT doc_id, n, sha256(norm) AS text_sha256,
            first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY norm) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE k AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(4294967295, list_reduce(
              list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                lambda c: CAST(ascii(c) AS BIGINT))),
              lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) % 20 AS k
          FROM conversations),
        d AS (
          SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM k WHERE k <> 0),
        f AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS n,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
            regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid
          FROM d),
        g AS (
          SELECT conv_id, turn, n, role, text, left(role, 1) AS i, solid = '' AS blank, solid <> '' AND seen AS copied,
            solid <> '' AND NOT seen AND right(solid, 1) NOT IN ('.', '!', '?') AS cut,
            coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS bad,
            5 * CAST(solid <> '' AND NOT seen AND right(solid, 1) NOT IN ('.', '!', '?') AS BIGINT) AS stay
          FROM f),
        s AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS n, {'c': CAST(0 AS BIGINT), 'a': '', 'r': ''} AS s0,
            CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s1,
            {'c': CAST(5 AS BIGINT), 'a': 'I', 'r': chr(10) || 'user:'} AS s2,
            {'c': CAST(10 AS BIGINT), 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s3
          FROM (SELECT DISTINCT conv_id FROM g)
          UNION ALL
          SELECT conv_id, n, s0, s1, s2, list_min([s3, CASE WHEN s2 IS NOT NULL THEN {'c': s2.c + 5, 'a': s2.a || 'I', 'r': s2.r || chr(10) || 'assistant:'} END])
          FROM (
            SELECT conv_id, n, s0, s1, s3, list_min(list_concat([s2], list_transform(list_filter([s0, s1, s3], lambda x: x IS NOT NULL),
              lambda x: {'c': x.c + 5, 'a': x.a || 'I', 'r': x.r || chr(10) || 'user:'}))) AS s2
            FROM (
              SELECT g.conv_id, g.n,
                {'c': s0.c + 2, 'a': s0.a || 'D', 'r': s0.r} AS s0,
                list_min([CASE WHEN s1 IS NOT NULL THEN {'c': s1.c + 2, 'a': s1.a || 'D', 'r': s1.r} END,
                  CASE WHEN i = 's' AND NOT blank AND NOT copied THEN {'c': s0.c + stay, 'a': s0.a || 'K', 'r': s0.r || chr(10) || role || ':' || text} END]) AS s1,
                list_min(list_concat([{'c': s2.c + 2, 'a': s2.a || 'D', 'r': s2.r}],
                  list_transform(list_filter([s0, s1, s3], lambda x: x IS NOT NULL AND i = 'u' AND NOT blank AND NOT copied),
                    lambda x: {'c': x.c + stay, 'a': x.a || 'K', 'r': x.r || chr(10) || role || ':' || text}),
                  list_transform(list_filter([s0, s1, s3], lambda x: x IS NOT NULL AND NOT blank AND NOT copied),
                    lambda x: {'c': x.c + 1 + stay, 'a': x.a || 'R', 'r': x.r || chr(10) || 'user:' || text}))) AS s2,
                list_min([{'c': s3.c + 2, 'a': s3.a || 'D', 'r': s3.r},
                  CASE WHEN i = 'a' AND NOT blank AND NOT copied THEN {'c': s2.c + stay, 'a': s2.a || 'K', 'r': s2.r || chr(10) || role || ':' || text} END,
                  CASE WHEN NOT blank AND NOT copied THEN {'c': s2.c + 1 + stay, 'a': s2.a || 'R', 'r': s2.r || chr(10) || 'assistant:' || text} END]) AS s3
              FROM s JOIN g ON g.conv_id IS NOT DISTINCT FROM s.conv_id AND g.n = s.n + 1))),
        h AS (
          SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (copied) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (bad) AS illegal
          FROM g GROUP BY conv_id),
        e AS (
          SELECT h.*, list_min([s0, s3]) AS best FROM h JOIN s ON s.conv_id IS NOT DISTINCT FROM h.conv_id AND s.n = h.n)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
