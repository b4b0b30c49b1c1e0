"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

OP1 = r"""
WITH thin AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS shuffle
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM thin GROUP BY source),
weighed AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM sizes),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, sid
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT *, least(cap, coalesce((SELECT level FROM levels WHERE cap >= level * weight
                                 ORDER BY cap / weight, sid LIMIT 1) * weight, cap)) AS target
  FROM levels),
counts AS (
  SELECT *, floor(target)::BIGINT AS words, ((floor(target)::BIGINT + 1023) // 1024)::BIGINT AS blocks
  FROM targets),
ranges AS (
  SELECT *, (sum(blocks) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) - blocks)::BIGINT AS first_block,
         greatest(1, length(bin(greatest(sum(blocks) OVER (), 1)::BIGINT - 1))) AS bits
  FROM counts),
slots AS (
  SELECT sid, ('0b' || reverse(lpad(bin(point), bits::INT, '0')))::BIGINT AS slot
  FROM (SELECT sid, bits, unnest(range(first_block, first_block + blocks)) AS point FROM ranges)),
schedule AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM slots),
streams AS (
  SELECT t.doc_id, t.size, s.sid, s.source_size, s.target, s.words,
         (sum(t.size) OVER (PARTITION BY s.sid ORDER BY t.shuffle, t.doc_id NULLS FIRST, t.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t.size)::BIGINT AS start
  FROM thin t JOIN ranges s ON t.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, words) - start)
        + greatest(0, least(source_size + start + size, words) - source_size - start))::BIGINT AS taken,
       slot AS first_slot
FROM streams t LEFT JOIN schedule s
  ON t.sid = s.sid AND t.size > 0 AND t.start < t.words AND t.start // 1024 = s.rank
"""

OP6 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES: dict[str, str] = {"op1_mix_sources": OP1, "op6_exact_dedup": OP6}
