"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_chat_format"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(text, '([\[<])(\\*)(/?INST\]|NL\]|/?s>|(?:image|audio|document)>)', '\1\\\2\3', 'g') AS body FROM said),
pieces AS (
  SELECT *, CASE WHEN role = 'assistant' THEN '<s>' || role || chr(10) || body || '</s>' || chr(10)
                 ELSE '[INST]' || role || chr(10) || body || '[/INST]' || chr(10) END AS piece FROM marked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, piece)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, piece) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
"""

SQL["op7_extendible_shards"] = """
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) AS b,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
levels AS (
  SELECT r, doc_id, b, h, d, sum(b) OVER (PARTITION BY d, h >> (60 - d)) AS t
  FROM sized, range(0, 40) AS steps(d))
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE right(repeat('0', 60) || bin(h >> (60 - d)), d::INT) END AS shard,
  CAST(d AS BIGINT) AS depth, CAST(0 AS BIGINT) AS page, CAST(b AS BIGINT) AS row_bytes, CAST(t AS BIGINT) AS shard_bytes
FROM levels WHERE t <= 1048576
QUALIFY row_number() OVER (PARTITION BY r ORDER BY d) = 1
"""

SQL["op10_source_mix"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    greatest(length(coalesce(text, '')), 1) AS n,
    greatest(greatest(length(coalesce(text, '')), 1) - length(translate(coalesce(text, ''), '#$%&*!|<>{}=^~', '')), 0) AS symbols,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS bits FROM documents),
keyed AS (
  SELECT *, -ln((CAST(bits AS DOUBLE) + 0.5) / 4503599627370496.0) / greatest(CAST(0.05 AS DOUBLE), CAST(1.0 AS DOUBLE) - CAST(10.0 AS DOUBLE) * symbols / n) AS key FROM words),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM words GROUP BY source),
weighed AS (
  SELECT *, 2 * source_size AS cap, [3, 1, 2][((place - 1) % 3 + 1)::INT] AS w FROM sources),
steps AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS closed, (SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER before, 0) AS free
  FROM weighed WINDOW before AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rated AS (
  SELECT min_by(rate, closed) FILTER (rate * w <= cap) AS rate
  FROM (SELECT *, ((SELECT sum(source_size) FROM sources) * CAST(1.5 AS DOUBLE) - closed) / free AS rate FROM steps)),
goals AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), rate * w) AS target FROM weighed, rated),
parted AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goals),
summed AS (
  SELECT k.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar
  FROM keyed k JOIN parted p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, source,
  CAST(epochs + CASE WHEN 2 * sofar + size <= 2 * rest THEN 1 ELSE 0 END AS BIGINT) AS times,
  CAST(size * (epochs + CASE WHEN 2 * sofar + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""

SQL["op11_line_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS d, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT r, d, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
shared AS (
  SELECT key, max(d) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT d) >= 3),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.d <> s.top AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS body FROM marked GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(body) AS kept_sha256 FROM docs JOIN kept USING (r)
"""
