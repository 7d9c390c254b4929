"""DuckDB text of the mixing query: one pair of steps for each level of the tree."""

from __future__ import annotations


def _share(level: str, parent: str, weight: str, above: str, name: str) -> str:
    """The children of one level with their weights, and what each is granted; ``parent`` names the levels above."""
    join = f"USING ({parent})" if parent else "ON true"
    keys = f"{parent}, " if parent else ""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}_nodes AS (
  SELECT {above}.*, kids.{level}, kids.capacity, {weight} AS weight
  FROM (SELECT {keys}{level}, 2 * sum(tokens) AS capacity FROM leaves GROUP BY ALL) kids JOIN {above} {join}
), {name}_run AS (
  SELECT *, granted - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / weight, {level}
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
         sum(weight) OVER ({by} ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM {name}_nodes
), {name}_full AS (
  SELECT *, capacity * open <= remain * weight AS is_full FROM {name}_run
), {name} AS (
  SELECT {keys}{level},
         CASE WHEN is_full THEN capacity
              ELSE (granted - coalesce(sum(capacity) FILTER (WHERE is_full) OVER ({by}), 0)) * weight
                   // sum(weight) FILTER (WHERE NOT is_full) OVER ({by}) END AS granted
  FROM {name}_full
)"""


DOMAIN_WEIGHT = "CASE kids.domain WHEN 'crawl' THEN 3 WHEN 'reference' THEN 4 WHEN 'forum' THEN 5 ELSE 1 END"
LANG_WEIGHT = """CASE kids.domain || ' ' || kids.lang WHEN 'crawl en' THEN 5 WHEN 'crawl de' THEN 2 WHEN 'crawl fr' THEN 2
  WHEN 'reference en' THEN 4 WHEN 'forum en' THEN 6 WHEN 'forum fr' THEN 2 ELSE 1 END"""
SOURCE_WEIGHT = """CASE kids.domain || ' ' || kids.lang || ' ' || kids.source WHEN 'reference en src1' THEN 3
  WHEN 'forum en src6' THEN 2 ELSE 1 END"""

OP6 = f"""
WITH docs AS (
  SELECT doc_id, coalesce(CASE WHEN source = 'src0' THEN 'crawl' WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5') THEN 'reference'
                               WHEN source IS NOT NULL THEN 'forum' END, 'unknown') AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL
), root AS (
  SELECT sum(tokens) AS granted FROM leaves
), {_share("domain", "", DOMAIN_WEIGHT, "root", "by_domain")},
{_share("lang", "domain", LANG_WEIGHT, "by_domain", "by_lang")},
{_share("source", "domain, lang", SOURCE_WEIGHT, "by_lang", "by_source")},
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN granted // tokens ELSE 0 END AS copies,
         CASE WHEN tokens > 0 THEN granted % tokens ELSE 0 END AS rest
  FROM by_source JOIN leaves USING (domain, lang, source)
), drawn AS (
  SELECT *, ('0x' || substr(md5('42:' || copies::BIGINT || ':' || doc_id), 1, 15))::BIGINT AS draw
  FROM (SELECT doc_id, domain, lang, source, tokens AS size FROM docs) JOIN plan USING (domain, lang, source)
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY domain, lang, source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken
  FROM drawn
)
SELECT doc_id, domain, lang, source, size::BIGINT AS tokens, copies::BIGINT AS copies,
       greatest(0, least(size, rest - taken))::BIGINT AS prefix_tokens
FROM placed
"""
