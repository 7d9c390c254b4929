"""DuckDB text of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from attrition.llm.oracle_mixing import OP6
from attrition.llm.oracle_prints import OP11, OP13

ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {BLANKS}), {ABC}) AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE first_doc IS NOT NULL AND doc_id <> first_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE first_doc IS NULL OR doc_id = first_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key)
GROUP BY doc_id
"""

WORDS = f"regexp_extract_all(translate(text, {ABC}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5 = f"""
WITH docs AS (
  SELECT doc_id, coalesce({WORDS}, []) AS words FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id, {WORDS} AS words FROM benchmark WHERE text IS NOT NULL
), asked AS (
  SELECT item_id, first, words[first:first + 12] AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS first FROM items WHERE len(words) > 0)
), widths AS (
  SELECT DISTINCT len(win) AS width FROM asked
), grams AS (
  SELECT doc_id, pos, width, words[pos:pos + width - 1] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM docs) CROSS JOIN widths
  WHERE pos + width - 1 <= len(words)
), hits AS (
  SELECT DISTINCT doc_id, pos, width, item_id FROM grams JOIN asked USING (win)
), inside AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS place FROM hits) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
), places AS (
  SELECT doc_id, words[pos] AS word, pos FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM docs)
), totals AS (
  SELECT word, count(*) AS n FROM places GROUP BY word
), parts AS (
  SELECT item_id, first, place, win[place] AS word, coalesce(n, 0) AS n
  FROM (SELECT item_id, first, win, unnest(range(1, len(win) + 1)) AS place FROM asked) LEFT JOIN totals ON totals.word = win[place]
), rarest AS (
  SELECT item_id, first, arg_min(word, n * 100 + place) AS word, count(DISTINCT word) AS n_words
  FROM parts GROUP BY item_id, first HAVING min(n) > 0
), anchors AS (
  SELECT item_id, first, n_words, doc_id, pos FROM rarest JOIN places USING (word)
), near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM (
    SELECT a.doc_id, a.item_id, a.first, a.pos
    FROM anchors a JOIN parts p ON a.item_id = p.item_id AND a.first = p.first
    JOIN places q ON q.doc_id = a.doc_id AND q.word = p.word AND abs(q.pos - a.pos) <= 17
    GROUP BY a.doc_id, a.item_id, a.first, a.pos, a.n_words HAVING count(DISTINCT p.word) = a.n_words
  ) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated,
       coalesce(n_near_items, 0) AS n_near_items
FROM docs LEFT JOIN inside USING (doc_id) LEFT JOIN held USING (doc_id) LEFT JOIN near USING (doc_id)
"""

OP10 = f"""
WITH RECURSIVE parts AS (
  SELECT page_id, contains(url, '://') AS ok, substr(url, instr(url, '://') + 3) AS rest FROM pages
), urls AS (
  SELECT page_id, CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), {ABC}) ELSE '' END AS host,
         CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM parts
), rules(rule_host, rule_path, says) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT DISTINCT host, path, rule_host || rule_path AS rule, says
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS by_rule FROM fits GROUP BY host, path
), shaped AS (
  SELECT urls.*, rule, by_rule,
         list_transform(string_split(regexp_replace(path, '^/', ''), '/')[1:16], lambda s:
           CASE WHEN regexp_matches(s, '^([0-9]+|[0-9a-f]{{8,}}|[0-9]+[-_][0-9_-]*)(\\.[a-z0-9]+)?$')
                THEN regexp_replace(s, '^[^.]*', '*') ELSE s END)
         || CASE WHEN len(string_split(regexp_replace(path, '^/', ''), '/')) > 16 THEN ['**'] ELSE [] END AS shape
  FROM urls LEFT JOIN best USING (host, path)
), leaves AS (
  SELECT host, shape, count(rule) AS n, count(*) FILTER (WHERE by_rule = 'block') AS b FROM shaped GROUP BY host, shape
), grown AS (
  SELECT host, shape, n, b, 0 AS depth, '' AS node FROM leaves
  UNION ALL
  SELECT host, shape, n, b, depth + 1, node || '/' || CASE WHEN kinds > 64 THEN '*' ELSE shape[depth + 1] END
  FROM (SELECT *, count(DISTINCT shape[depth + 1]) OVER (PARTITION BY host, node) AS kinds FROM grown WHERE depth < len(shape))
), nodes AS (
  SELECT host, depth, node, sum(n) AS n, sum(b) AS b FROM grown GROUP BY host, depth, node
), parents AS (
  SELECT *, CASE WHEN depth > 0 THEN substr(node, 1, length(node) - length(string_split(node, '/')[-1]) - 1) END AS above FROM nodes
), sums AS (
  SELECT host, depth, above, sum(n) AS n_all, sum(b) AS b_all FROM parents WHERE depth > 0 GROUP BY ALL
), tested AS (
  SELECT parents.*, n > 0 AND power(b - n * (b_all::DOUBLE / n_all::DOUBLE), 2)
         <= 3.84::DOUBLE * n * (b_all::DOUBLE / n_all::DOUBLE) * (1 - b_all::DOUBLE / n_all::DOUBLE) AS same
  FROM parents JOIN sums USING (host, depth, above)
), pools AS (
  SELECT host, depth, above, sum(n) AS n_pool, sum(b) AS b_pool FROM tested WHERE same GROUP BY ALL
), branches AS (
  SELECT host, depth, above, node, CASE WHEN same THEN n_pool ELSE n END AS n, CASE WHEN same THEN b_pool ELSE b END AS b
  FROM tested LEFT JOIN pools USING (host, depth, above)
), judged AS (
  SELECT host, 0 AS depth, node, n, b, 0.2::DOUBLE AS outside FROM nodes WHERE depth = 0
  UNION ALL
  SELECT c.host, c.depth, c.node, c.n, c.b, (judged.b - c.b + 4.0::DOUBLE * outside) / (judged.n - c.n + 4.0::DOUBLE)
  FROM judged JOIN branches c ON c.host = judged.host AND c.depth = judged.depth + 1 AND c.above = judged.node
), ends AS (
  SELECT grown.host, shape, substr(grown.node, 2) AS template, (judged.b + 4.0::DOUBLE * outside) / (judged.n + 4.0::DOUBLE) AS purity
  FROM grown JOIN judged USING (host, depth, node) WHERE depth = len(shape)
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       template, purity
FROM shaped JOIN ends USING (host, shape)
"""

OP9 = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_inner_product(x.v, y.v) / sqrt(list_inner_product(x.v, x.v) * list_inner_product(y.v, y.v)) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links,
       min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""

TEXTS = {
    "op2_line_dedup": OP2,
    "op5_decontaminate": OP5,
    "op6_mixing": OP6,
    "op9_vector_dedup": OP9,
    "op10_url_filter": OP10,
    "op11_imatch": OP11,
    "op13_prefix_trie": OP13,
}
