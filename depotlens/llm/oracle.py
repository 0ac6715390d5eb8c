"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from depotlens.llm import secret_scan, url_filter
from depotlens.llm.common import ASCII_UPPER


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _lower(c: str) -> str:
    return f"translate({c}, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"


def url_filter_sql() -> str:
    rules = ", ".join("(" + ", ".join(map(_text, r)) + ")" for r in url_filter.RULES)
    parts, query, tracking = map(_text, (url_filter.URL_PARTS, url_filter.URL_QUERY, url_filter.TRACKING))
    return f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS n,
         {_lower(f"coalesce(regexp_extract(url, {parts}, 1), '')")} AS host,
         coalesce(regexp_extract(url, {parts}, 2), '') AS path,
         list_sort([x for x in string_split(coalesce(regexp_extract(url, {query}, 1), ''), '&')
                    if x <> '' AND NOT regexp_matches(x, {tracking})]) AS params
  FROM pages),
named AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
         || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM parts),
listed AS (SELECT canonical FROM named WHERE canonical <> '' GROUP BY canonical HAVING count(*) > 1),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule,
       coalesce(best.verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM named LEFT JOIN best USING (n)"""


def secret_scan_sql() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        p = _text(r.pattern)
        parts.append(f"""
  SELECT n, {i} AS kind, {_text(r.kind)} AS name, unnest(matches) AS m, unnest(held) AS h, unnest(gaps[:len(matches)]) AS gap,
         generate_subscripts(matches, 1) AS i
  FROM (SELECT n, regexp_extract_all(text, {p}) AS matches, regexp_extract_all(text, {p}, {r.group}) AS held,
               string_split_regex(text, {p}) AS gaps FROM docs)""")
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(secret_scan.RULES))
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{r.kind}" for i, r in enumerate(secret_scan.BASE))
    said = "name || ':' || (finish - length(m)) || ':' || finish"
    base = f"kind < {len(secret_scan.BASE)}"
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY n, kind ORDER BY i)::BIGINT AS finish FROM found),
counted AS (SELECT * FROM placed WHERE length(h) >= CASE kind {least} END),
texts AS (
  SELECT n, {counts}, string_agg({said}, ',' ORDER BY finish - length(m), kind) FILTER ({base}) AS base,
         string_agg({said}, ',' ORDER BY finish - length(m), kind) AS spans
  FROM counted GROUP BY n)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (n)"""


def minhash_sql(words: int = 3, percent: int = 85) -> str:
    shingle = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(words))
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, [x for x in string_split_regex({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+') if x <> ''] AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([{shingle} for i in range(1, len(ws) - {words - 2})]) END AS held
  FROM texts),
shingles AS (SELECT doc_id, len(held) AS n, unnest(held) AS s FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reached(doc_id, r) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.r = links.x)
SELECT doc_id, len(held) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)"""


def ngram_join_sql(words: int = 3, percent: int = 90) -> str:
    """The columns of the near-duplicate query but ``kept``, at another threshold."""
    return minhash_sql(words, percent).replace(", doc_id = component_id AS kept", "")


def fill_in_middle_sql() -> str:
    return """
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
hashed AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM docs),
parted AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM hashed),
texts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
  FROM parted)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM texts"""


def hard_negatives_sql() -> str:
    return """
WITH valid AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vecs AS (SELECT *, row_number() OVER (ORDER BY vec_id, label, q) AS r FROM valid),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CASE WHEN len(a.q) = 0 THEN 0 ELSE list_inner_product(a.q, b.q) END::BIGINT AS score
  FROM vecs a JOIN vecs b ON len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT r, anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS place
  FROM scored WHERE same AND other_id <> anchor_id QUALIFY place <= 5)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
       (row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.other_id))::INTEGER AS rank
FROM positives p JOIN scored s ON s.r = p.r
WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""
