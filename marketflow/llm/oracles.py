"""DuckDB SQL for the registered queries that SQL can express."""

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP3 = """
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    4 + length(regexp_replace(role, '[\\\\<#:]', '..', 'g')) + 2
      + length(regexp_replace(text, '[\\\\<#]', '..', 'g')) + 8 AS chars
  FROM m
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS whole,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS learned,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM n GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars
FROM g
"""

OP4 = r"""
WITH k AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce('s' || source, 'n') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents
), d AS (
  SELECT doc_id, source, size,
    CAST('0x' || substr(md5(key || ':' || (row_number() OVER (PARTITION BY key) - 1)), 1, 9) AS BIGINT) AS h
  FROM k
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM totals
), filled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW f AS (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM filled
), plan AS (
  SELECT *, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) AS copies,
    target - coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) * source_size AS budget
  FROM targets
), sums AS (
  SELECT source, h, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source, h
), run AS (
  SELECT *, coalesce(sum(words) OVER (
    PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM sums
), edge AS (
  SELECT p.source, CASE WHEN 2 * (p.budget - r.below) >= r.words THEN r.h + 1 ELSE r.h END AS threshold
  FROM plan p JOIN run r ON p.source IS NOT DISTINCT FROM r.source
  WHERE r.below <= p.budget AND p.budget < r.below + r.words
)
SELECT d.doc_id, d.size, p.source_size, p.target,
  d.size * (p.copies + CASE WHEN d.h < coalesce(e.threshold, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN edge e ON p.source IS NOT DISTINCT FROM e.source
"""

ORACLES = {
    "op1_exact_topk": OP1,
    "op3_chat_trees": OP3,
    "op4_hash_mix": OP4,
}
