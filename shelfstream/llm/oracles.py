"""SQL of the queries whose results SQL can express."""

from __future__ import annotations

from shelfstream.llm import licenses, mixing

SQL: dict[str, str] = {}

SQL["op3_warc"] = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), k AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html, n >= 100) END AS first FROM p
)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to, url
FROM k
"""

SQL["op5_mixing"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{', '.join(f'{w}.0::DOUBLE' for w in mixing.WEIGHTS)}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM d GROUP BY source
), rounds AS (
  SELECT 0 AS k, 0.0::DOUBLE AS level
  UNION ALL
  SELECT k + 1, (SELECT ({mixing.SHARE}::DOUBLE * sum(source_size)
      - coalesce(sum(CASE WHEN weight * rounds.level > source_size * 2.0::DOUBLE THEN source_size * 2.0::DOUBLE END), 0))
      / sum(CASE WHEN weight * rounds.level > source_size * 2.0::DOUBLE THEN NULL ELSE weight END) FROM s)
  FROM rounds WHERE k < 50
), t AS (
  SELECT source, source_size,
    least(weight * (SELECT max(level) FROM rounds), source_size * 2.0::DOUBLE) AS target FROM s
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1 END AS rate FROM t
), drawn AS (
  SELECT doc_id, d.source, size, source_size, target, seed, (floor(rate)
    + CASE WHEN ('0x' || substr(md5(seed || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE
        < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range({mixing.SEEDS})) AS seed)
), best AS (
  SELECT source, seed FROM (
    SELECT source, seed, abs(sum(size * copies) - any_value(target)) AS far FROM drawn GROUP BY source, seed
  ) QUALIFY row_number() OVER (PARTITION BY source ORDER BY far, seed) = 1
)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken
FROM drawn JOIN best ON drawn.source IS NOT DISTINCT FROM best.source AND drawn.seed = best.seed
"""

_PHRASES = " UNION ALL ".join(
    f"SELECT '{p}' AS phrase, '{label}' AS label" for p, label in licenses.PHRASES.items()
)
_TEMPLATES = " UNION ALL ".join(
    f"SELECT '{label}' AS label, list_distinct(string_split('{t}', ' ')) AS words, {licenses.longest(t)} AS most"
    for label, t in licenses.TEMPLATES
)
SQL["op9_licenses"] = f"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
), w AS (
  SELECT doc_id, low, list_filter(string_split_regex(low, '{licenses.BETWEEN}'), lambda x: x <> '') AS words FROM d
), p AS (
  SELECT *, string_split(phrase, ' ') AS parts FROM ({_PHRASES})
), b AS (
  SELECT doc_id, label, i - 1 AS place
  FROM (SELECT doc_id, words, label, parts, unnest(range(1, len(words) + 1)) AS i FROM w, p
        WHERE contains(low, parts[1]) AND contains(low, parts[2]))
  WHERE words[i : i + len(parts) - 1] = parts
), base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id
), l AS (
  SELECT doc_id, label, w.words, t.words AS members, most, len(t.words) AS n, ceil({licenses.THRESHOLD} * len(t.words) - 1e-9) AS need
  FROM w, ({_TEMPLATES}) t WHERE len(list_intersect(w.words, t.words)) >= ceil({licenses.THRESHOLD} * len(t.words) - 1e-9)
), m AS (
  SELECT doc_id, label, max(held / n) AS containment
  FROM (SELECT doc_id, label, n, need, len(list_intersect(words[i : i + most - 1], members))::DOUBLE AS held
        FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM l))
  WHERE held >= need GROUP BY doc_id, label
), labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM m UNION ALL SELECT doc_id, label FROM b) GROUP BY doc_id
), best AS (SELECT doc_id, max(containment) AS containment FROM m GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN best USING (doc_id)
"""

SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_inner_product(a.vec, v.vec)::BIGINT AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
