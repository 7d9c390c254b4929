"""DuckDB text of the fingerprint and trie queries, written apart from the operators."""

from __future__ import annotations

ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11 = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), followed AS (
  SELECT *, coalesce(lead(doc_id) OVER down, first_value(doc_id) OVER down) AS next_id,
         coalesce(lead(text) OVER down, first_value(text) OVER down) AS next_text
  FROM docs WINDOW down AS (ORDER BY doc_id DESC)
), texts AS (
  SELECT doc_id, 'own' AS kind, text FROM docs
  UNION ALL
  SELECT doc_id, 'edited', substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) FROM followed
), numbered AS (
  SELECT doc_id, kind, text, list_transform(
    list_distinct(list_filter(string_split_regex(translate(text, {ABC}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')),
    lambda w: ('0x' || substr(md5(w), 1, 15))::BIGINT) AS terms
  FROM texts
), band AS (
  SELECT term, term % 256 AS byte FROM (SELECT unnest(terms) AS term FROM numbered WHERE kind = 'own')
  GROUP BY term HAVING count(*) * 200 >= (SELECT count(*) FROM docs) AND count(*) * 5 <= (SELECT count(*) FROM docs)
), lexicon AS (
  SELECT term, CASE WHEN byte < 64 THEN byte // 32 WHEN byte < 128 THEN 2 + (byte - 64) // 8
                    WHEN byte < 192 THEN 10 + (byte - 128) // 4 ELSE 26 + (byte - 192) // 2 END AS part FROM band
), hashed AS (
  SELECT doc_id, kind, part, substr(md5(string_agg(term::VARCHAR, ',' ORDER BY term)), 1, 8) AS hash
  FROM (SELECT doc_id, kind, unnest(terms) AS term FROM numbered) JOIN lexicon USING (term) GROUP BY ALL
), laid AS (
  SELECT doc_id, kind, list(coalesce(hash, '-') ORDER BY part) AS hashes, count(hash) AS filled
  FROM (SELECT doc_id, kind, unnest(range(58)) AS part FROM numbered) LEFT JOIN hashed USING (doc_id, kind, part) GROUP BY doc_id, kind
), prints AS (
  SELECT doc_id, kind, text, filled, hashes,
         CASE WHEN filled = 0 THEN 'all:' || md5(array_to_string(list_sort(terms), ',')) ELSE array_to_string(hashes, '.') END AS print
  FROM numbered JOIN laid USING (doc_id, kind)
), pairs AS (
  SELECT f.doc_id, f.n, e.text AS edited, o.print, e.print AS edited_print, x.print AS next_print,
         o.filled, e.filled AS edited_filled, x.filled AS next_filled, o.hashes, e.hashes AS edited_hashes, x.hashes AS next_hashes
  FROM followed f JOIN prints o ON o.doc_id = f.doc_id AND o.kind = 'own' JOIN prints e ON e.doc_id = f.doc_id AND e.kind = 'edited'
  JOIN prints x ON x.doc_id = f.next_id AND x.kind = 'own'
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, print AS fingerprint, edited_print AS edited_fingerprint,
  CASE WHEN print = edited_print THEN 1.0::DOUBLE WHEN filled = 0 OR edited_filled = 0 THEN 0.0::DOUBLE
       ELSE len(list_filter(list_zip(hashes, edited_hashes), lambda p: p[1] = p[2] AND p[1] <> '-'))::DOUBLE
            / len(list_filter(list_zip(hashes, edited_hashes), lambda p: p[1] <> '-' OR p[2] <> '-')) END AS near_edited,
  CASE WHEN print = next_print THEN 1.0::DOUBLE WHEN filled = 0 OR next_filled = 0 THEN 0.0::DOUBLE
       ELSE len(list_filter(list_zip(hashes, next_hashes), lambda p: p[1] = p[2] AND p[1] <> '-'))::DOUBLE
            / len(list_filter(list_zip(hashes, next_hashes), lambda p: p[1] <> '-' OR p[2] <> '-')) END AS near_next
FROM pairs
"""

# CRC-32 bit by bit: a byte is met, then eight shifts follow it.
_STEPS = "flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC = f"""xor(list_reduce(list_concat([4294967295::BIGINT], {_STEPS}),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT)"""

OP13 = f"""
WITH placed AS (
  SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(turn ORDER BY place) AS turns, any_value({_CRC} % 6) AS h FROM placed GROUP BY conv_id
), whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), member AS (
  SELECT conv_id, turns, d, turns[1:d] AS beginning
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM whole)
), node AS (
  SELECT beginning, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, arg_min(turns, conv_id) AS turns,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = len(turns)), '') AS ends,
         (count(*) - 1) * CASE WHEN any_value(d) = 0 THEN 0 ELSE length(any_value(beginning)[-1].t) END AS own
  FROM member GROUP BY beginning
), child AS (
  SELECT beginning[1:depth - 1] AS beginning, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), leaf AS (
  SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN child USING (beginning)
), total AS (
  SELECT beginning[1:up] AS beginning, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved
  FROM (SELECT beginning, own, n_children, unnest(range(depth + 1)) AS up FROM leaf) GROUP BY 1
)
SELECT leaf.conv_id, leaf.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, leaf.n_convs, leaf.n_children,
       n_leaves, saved::BIGINT AS saved_tokens, sha256(leaf.ends) AS ends_sha256
FROM leaf JOIN total USING (beginning) LEFT JOIN node parent ON leaf.depth > 0 AND parent.beginning = leaf.beginning[1:leaf.depth - 1]
"""
