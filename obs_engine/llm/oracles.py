"""DuckDB SQL of the text operators that SQL can express."""

from __future__ import annotations

#: op11: impacts of every posting of the items' terms, summed.
RANKED_SEARCH = r"""
WITH terms AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM documents)
), lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, whole GROUP BY term, docs
),
asked AS (
  SELECT DISTINCT item_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark)
),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // tokens))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), whole
  GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""

#: op12: windows of 35 words by their whole text.
SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, greatest(len(w) - 33, 1)::BIGINT)) AS s FROM docs
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM starts JOIN docs USING (doc_id)
), often AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM windows WHERE h IN (SELECT h FROM often)
), gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         [x.word FOR x IN list_transform(w, lambda word, i: {'word': word, 'i': i}) IF NOT list_contains(ps, x.i)], ' ') END) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id)
"""

#: op13: every prefix written out, its members listed.
PREFIX_TRIE = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(9 * strlen(conv_id::VARCHAR)), lambda k: k::BIGINT)),
    lambda crc, k: CASE WHEN k % 9 = 0 THEN xor(crc, ascii(substr(conv_id::VARCHAR, (k // 9 + 1)::INTEGER, 1))::BIGINT)
                     WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN ordered o ON o.conv_id = c.base WHERE pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id WHERE pos >= h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
         md5(strlen(role)::VARCHAR || ':' || role || text) AS id,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt
), chains AS (
  SELECT conv_id, depth, words, list(id) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM convs
), named AS (SELECT conv_id, depth, words, md5(array_to_string(path, '')) AS node, md5(array_to_string(path[:-2], '')) AS above FROM chains),
lengths AS (SELECT conv_id, max(depth) AS length FROM named GROUP BY conv_id),
nodes AS (
  SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM named JOIN lengths USING (conv_id) GROUP BY depth, node
), children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
tree AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c USING (depth, node)
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above
), pairs AS (
  SELECT up.depth, up.node, t.depth AS below, t.conv_id AS least, t.n_children, t.n_convs, t.words
  FROM tree t JOIN named low ON low.conv_id = t.conv_id AND low.depth = t.depth
  JOIN named up ON up.conv_id = t.conv_id AND up.depth <= t.depth
), sums AS (
  SELECT depth, node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM pairs GROUP BY depth, node
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM tree JOIN sums USING (depth, node)
"""

ORACLES = {
    "op11_ranked_search": RANKED_SEARCH,
    "op12_substring_dedup": SUBSTRING_DEDUP,
    "op13_prefix_trie": PREFIX_TRIE,
}
