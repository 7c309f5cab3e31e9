"""DuckDB SQL of the queries that SQL can express."""

URL_FILTER = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '(^|[.-])(adult|casino|malware|phishing|porn|spam|torrent|warez|xxx)([.-]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
), hits AS (SELECT doc_id, i, g.size, item_id FROM grams g JOIN windows x ON g.gram = x.gram AND g.size = x.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, i, size FROM hits), unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.list, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

TRIE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, max(pos) AS n FROM turns GROUP BY conv_id),
steps AS (  -- the bytes of the decimal id, each followed by seven zeros: eight steps of the checksum a byte
  SELECT conv_id, n, flatten([[ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(conv_id::VARCHAR, '')]) AS s FROM ids),
heads AS (
  SELECT conv_id, n, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || s, lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 4 AS h FROM steps),
joined AS (SELECT h.*, least(h.h, coalesce(b.n, 0)) AS n_head FROM heads h LEFT JOIN ids b ON b.conv_id = h.base),
rebuilt AS (
  SELECT j.conv_id, t.pos AS depth, t.role, t.text FROM joined j JOIN turns t ON t.conv_id = j.base AND t.pos <= j.n_head
  UNION ALL SELECT j.conv_id, j.n_head + t.pos - j.h, t.role, t.text FROM joined j JOIN turns t ON t.conv_id = j.conv_id AND t.pos > j.h),
entries AS (
  SELECT conv_id, 0 AS depth, []::VARCHAR[] AS path, '' AS text FROM ids
  UNION ALL SELECT conv_id, depth, list(sha256(role) || sha256(text)) OVER (PARTITION BY conv_id ORDER BY depth), text FROM rebuilt),
ended AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM entries),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * len(regexp_extract_all(min(text), '[^\x20\x09-\x0D]+')) * (depth > 0)::INT AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM ended GROUP BY depth, path),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1 : n.depth - 1]),
children AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c ON c.parent_conv_id = l.conv_id AND c.depth = l.depth),
above AS (  -- every node with each node over it and itself
  SELECT path[1 : up] AS path, up AS depth, (n_children = 0)::INT AS leaf, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted)),
sums AS (SELECT depth, path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY depth, path)
SELECT c.conv_id, c.depth::BIGINT AS depth, c.parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.depth = c.depth AND s.path = c.path
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS one, generate_subscripts(w, 1) AS pos FROM cut),
follow AS (SELECT lang, one, lead(one) OVER p AS two, lead(one, 2) OVER p AS three FROM words WINDOW p AS (PARTITION BY id ORDER BY pos)),
grams AS (
  SELECT lang, 1 AS k, one AS g FROM follow
  UNION ALL SELECT lang, 2, one || ' ' || two FROM follow WHERE two IS NOT NULL
  UNION ALL SELECT lang, 3, one || ' ' || two || ' ' || three FROM follow WHERE three IS NOT NULL),
f AS (SELECT lang, k, g, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
split AS (
  SELECT lang, k, g, n AS a, unnest(CASE WHEN k = 2 THEN [1] WHEN k = 3 THEN [1, 2] ELSE [] END) AS part, string_split(g, ' ') AS w FROM f),
cuts AS (SELECT lang, k, g, a, part, array_to_string(w[1 : part], ' ') AS head, array_to_string(w[part + 1 : k], ' ') AS rest FROM split),
scores AS (
  SELECT c.*, p.n AS l, q.n AS r, (1000000::HUGEINT * a * a) // (p.n::HUGEINT * q.n) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.g = c.head JOIN f q ON q.lang = c.lang AND q.g = c.rest),
scored AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, part) = 1),
inside AS (
  SELECT lang, g, max(n) AS n FROM (
    SELECT lang, array_to_string(string_split(g, ' ')[1:2], ' ') AS g, n FROM f WHERE k = 3
    UNION ALL SELECT lang, array_to_string(string_split(g, ' ')[2:3], ' '), n FROM f WHERE k = 3) GROUP BY lang, g),
kept AS (
  SELECT c.lang, c.g, c.a, c.l, c.r, c.score FROM scored c LEFT JOIN inside i ON i.lang = c.lang AND i.g = c.g
  WHERE i.n IS NULL OR 100 * i.n < 50 * c.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, total.n AS n, score::BIGINT AS score
FROM kept JOIN total ON total.lang = kept.lang
QUALIFY rank <= 2000
"""
