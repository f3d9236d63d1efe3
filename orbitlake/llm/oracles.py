"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from orbitlake.llm import decontaminate, lexical, passages, urls

_LOWER = f"translate(coalesce({{}}, ''), '{urls.UPPER}', '{urls.LOWER}')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SIZE = decontaminate.WINDOW
CONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + {_SIZE}], ' ') AS win, least(len(w), {_SIZE}) AS n
  FROM (SELECT *, unnest(range(0, greatest(len(w) - {_SIZE - 1}, 1))) AS s FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s
    FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, n, item_id FROM place JOIN win USING (win, n)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS word FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {decontaminate.HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _rounds() -> str:
    parts = []
    for number in range(urls.ROUNDS):
        parts.append(
            f"""rank{number + 1} AS MATERIALIZED (
  SELECT host, kind, sum(rank) AS rank FROM (
    SELECT host, kind, rank * {1 - urls.DAMPING} AS rank FROM rank0
    UNION ALL
    SELECT l.target, l.kind, r.rank * l.share * {urls.DAMPING}
    FROM rank{number} r JOIN share l ON l.source = r.host AND l.kind = r.kind) GROUP BY host, kind)"""
        )
    return ",\n".join(parts)


_PART = f"coalesce(regexp_extract(url, '{urls.URL}', {{}}), '')"
_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in urls.RULES)
_LINK = urls.LINK.replace("'", "''")
VERDICTS = f"""
WITH rules(rule_host, rule_path, ruled) AS (VALUES {_RULES}),
page AS (
  SELECT page_id, html, {_LOWER.format(_PART.format(1))} AS host, {_PART.format(2)} AS path,
    row_number() OVER () AS row FROM pages),
fit AS (
  SELECT row, max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'ruled': ruled}}) AS best
  FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY row),
judged AS (
  SELECT page_id, host, path, best.rule AS rule, best.ruled AS ruled FROM page LEFT JOIN fit USING (row)),
mark AS (
  SELECT host, CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, count(*) AS n
  FROM judged WHERE ruled IS NOT NULL GROUP BY ALL),
rank0 AS MATERIALIZED (SELECT host, kind, n / sum(n) OVER (PARTITION BY kind) AS rank FROM mark),
found AS (
  SELECT host AS source, {_LOWER.format("target")} AS target
  FROM (SELECT host, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS target FROM page)),
link AS (
  SELECT source, target, count(*) AS n FROM found WHERE source <> '' AND source <> target GROUP BY ALL),
both_ways AS (
  SELECT 'trust' AS kind, source, target, n FROM link
  UNION ALL SELECT 'distrust', target, source, n FROM link),
share AS MATERIALIZED (
  SELECT kind, source, target, n / sum(n) OVER (PARTITION BY kind, source) AS share FROM both_ways),
{_rounds()},
bad AS (
  SELECT host FROM rank{urls.ROUNDS} GROUP BY host
  HAVING coalesce(sum(rank) FILTER (kind = 'distrust'), 0)
    > {urls.RATIO} * coalesce(sum(rank) FILTER (kind = 'trust'), 0))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

_RUN = passages.WINDOW
REPEATED_PASSAGES = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
place AS (
  SELECT r, s, array_to_string(w[s : s + {_RUN - 1}], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - {_RUN - 2})) AS s FROM doc WHERE len(w) >= {_RUN})),
often AS (SELECT win FROM place GROUP BY win HAVING count(*) > 1),
covered AS (SELECT DISTINCT r, unnest(range(s, s + {_RUN})) AS k FROM place JOIN often USING (win)),
gone AS (
  SELECT r, count(*) AS n_removed, count(*) FILTER (coalesce(k - before, 2) > 1) AS n_spans
  FROM (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS before FROM covered) GROUP BY r),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM doc),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY k) AS kept FROM word ANTI JOIN covered USING (r, k) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM doc LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
RANKED = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM doc WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
ask AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
term AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM ask) GROUP BY q, term),
score AS (
  SELECT q, r, CAST(sum(times * weight * ((1000000000 * tf) //
    (1000 * tf + 8 * (100 - 75 + ((75 * len(w) * docs) // words))))) AS BIGINT) AS score
  FROM term JOIN weight USING (term) JOIN tf USING (term) JOIN doc USING (r), total GROUP BY q, r),
ranked AS (
  SELECT q, doc_id, score, CAST(row_number() OVER (
    PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM score JOIN doc USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN ask USING (q) WHERE rank <= {lexical.TOP}
"""
