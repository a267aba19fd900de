"""SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""

CHAT_FORMATTING = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
marked AS (
    SELECT *,
           lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS role_before,
           replace(replace(replace(replace(text, '\', '\s'), '</turn>', '\t'), '</part>', '\p'),
                   '### ', '\h') AS safe_text,
           replace(replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\t'), '</part>', '\p'),
                   '### ', '\h'), ':', '\c') AS safe_role
    FROM said
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(safe_text) + CASE
           WHEN role_before IS NOT DISTINCT FROM role THEN length('</part>')
           ELSE length('### ' || safe_role || ': ' || '</turn>' || chr(10)) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
),
weighed AS (
    SELECT source, source_size, CAST(CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
           CAST(2 * source_size AS DOUBLE) AS bound
    FROM sources
),
levels AS (
    SELECT bound / weight AS full_at,
           (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
            - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
),
aimed AS (
    SELECT source, source_size, least(bound, weight * (SELECT arg_min(level, full_at) FROM levels WHERE level < full_at))
           AS target
    FROM weighed
),
rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0
               AS chance
    FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
           AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""

SQL = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_chat_formatting": CHAT_FORMATTING,
    "op6_mixing": MIXING,
    "op7_top_k": TOP_K,
}
