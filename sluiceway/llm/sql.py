"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, ('0x' || md5('0:' || doc_id)[1:15])::BIGINT AS k, crc32 FROM (SELECT *, 0 AS crc32 FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
c AS (SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM r),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
p AS (SELECT *, cap * rest <= (total - before) * weight AS capped FROM o),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE (total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)) * weight / sum(weight) FILTER (WHERE NOT capped) OVER () END AS target FROM p),
m AS (SELECT doc_id, size, t.source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS upto,
  floor(target)::BIGINT AS budget FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM m)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - upto)))::BIGINT AS taken FROM e
"""

LINE_DEDUP = r"""
WITH t AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
  regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'),
    '(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer|title|body|head|html|blockquote|pre|aside|main|form)(?:[\s/][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS plain FROM pages),
l AS (SELECT page_id, host, list_filter(list_transform(string_split(plain, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '') AS lines FROM t),
e AS (SELECT page_id, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM l),
h AS (SELECT host, count(*) AS total FROM l GROUP BY 1),
c AS (SELECT host, line, count(DISTINCT page_id) AS pages FROM e GROUP BY 1, 2),
b AS (SELECT host, line FROM c JOIN h USING (host) WHERE pages >= 2 AND pages > 0.2::DOUBLE * total),
m AS (SELECT page_id, pos, e.line, b.line IS NOT NULL AS dropped FROM e LEFT JOIN b ON e.host = b.host AND e.line = b.line),
g AS (SELECT page_id, count(*) FILTER (WHERE dropped) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS text FROM m GROUP BY 1)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(text, '') AS text FROM l LEFT JOIN g USING (page_id)
"""

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
d AS (SELECT doc_id, CASE WHEN len(words) >= 4 THEN list_sort(list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams FROM w),
s AS (SELECT min(doc_id) AS id, grams, len(grams) AS n FROM d WHERE len(grams) > 0 GROUP BY grams),
e AS (SELECT id, n, unnest(grams) AS g FROM s),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared, any_value(a.n + b.n) AS sizes FROM e a JOIN e b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
k AS (SELECT a, b FROM p WHERE 100 * shared >= 85 * (sizes - shared)),
l AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT id, id AS root FROM s UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT grams, min(root) AS component_id FROM r JOIN s USING (id) GROUP BY grams)
SELECT doc_id, len(d.grams)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM d LEFT JOIN c USING (grams)
"""
