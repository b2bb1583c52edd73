"""SQL that must give the same rows as the queries of this subpackage."""

BENCHMARK_HITS = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), v AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), p AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)
), m AS (SELECT doc_id, n, i, item_id FROM p JOIN v USING (n, k)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM m) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def url_filter(allow: list[str], block: list[str], hosts: list[str]) -> str:
    rules = ", ".join(f"('{k}', '{v}')" for v, keys in (("allow", allow), ("block", block)) for k in keys)
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in hosts)
    return rf"""
WITH u AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), r AS (
    SELECT rule, verdict, split_part(rule, '/', 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath FROM (VALUES {rules}) AS t(rule, verdict)
), m AS (
    SELECT *, (
        SELECT arg_max({{'rule': rule, 'verdict': r.verdict}}, length(rule)) FROM r
        WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
    ) AS best FROM u
)
SELECT page_id, host, path, best.rule AS rule,
    coalesce(best.verdict, CASE WHEN {listed} THEN 'block' ELSE 'allow' END) AS verdict
FROM m
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
sizes AS (SELECT unnest([1, 2, 3, 4]) AS size),
starts AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size),
counts AS (
  SELECT lang, size, w[i : i + size - 1] AS phrase, count(*) AS f
  FROM starts GROUP BY ALL HAVING count(*) >= 30
),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, first.size AS k, first.f AS l, rest.f AS r,
    (2000000::HUGEINT * c.f // (first.f::HUGEINT + rest.f))::BIGINT AS score
  FROM counts c
  JOIN counts first ON first.lang = c.lang AND first.size < c.size AND first.phrase = c.phrase[1 : first.size]
  JOIN counts rest ON rest.lang = c.lang AND rest.size = c.size - first.size AND rest.phrase = c.phrase[first.size + 1 : c.size]
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT c.lang, c.f, s.size AS part_size, unnest([c.phrase[j : j + s.size - 1] FOR j IN range(1, c.size - s.size + 2)]) AS part
  FROM counts c, sizes s WHERE s.size >= 2 AND s.size < c.size
),
replaced AS (SELECT lang, part AS phrase, max(f) AS f FROM parts GROUP BY lang, part),
ranked AS (
  SELECT w.*, array_to_string(w.phrase, ' ') AS joined
  FROM lowest w LEFT JOIN replaced x ON x.lang = w.lang AND x.phrase = w.phrase
  WHERE x.f IS NULL OR 100::HUGEINT * x.f < 80::HUGEINT * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, joined) AS rank, joined AS phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
    list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
