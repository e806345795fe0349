"""The queries that SQL can express, as SQL for DuckDB."""

import math

from shiftwell.llm import url_templates as urls
from shiftwell.llm.divergence import LEAST_DOCUMENTS, TOP
from shiftwell.llm.infilling import RATE, SPM
from shiftwell.llm.infilling import SEED as FIM_SEED
from shiftwell.llm.queries import DOMAIN, MAX_EPOCHS, SEED, URL_RULES, WEIGHTS

SQL: dict[str, str] = {}


def _weight(path: list[str]) -> str:
    """The weight of a node; later entries win, as in the operator."""
    cases = [
        " AND ".join(f"{column} = '{name}'" for column, name in zip(path, names) if name != "*")
        + f" THEN {weight}"
        for names, weight in reversed(WEIGHTS.items())
        if len(names) == len(path)
    ]
    return f"CASE WHEN {' WHEN '.join(cases)} ELSE 1 END" if cases else "1"


def _level(name: str, path: list[str], above: str | None) -> str:
    """Shares of the nodes of one level, by the order of capacity per weight."""
    parent = ", ".join(path[:-1])
    by = f"PARTITION BY {parent}" if parent else ""
    order = ", ".join(path)
    budget = "a.budget" if above else "(SELECT sum(tokens) FROM leaves)"
    join = f"JOIN {above} a USING ({parent})" if above else ""
    return f"""
{name}_nodes AS (
  SELECT *, {budget}::HUGEINT AS total FROM (
    SELECT {order}, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS capacity,
           ({_weight(path)})::HUGEINT AS weight
    FROM leaves GROUP BY {order}) n {join}),
{name}_ordered AS (
  SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM {name}_nodes
  WINDOW w AS ({by} ORDER BY capacity::DOUBLE / weight::DOUBLE, {order})),
{name}_full AS (
  SELECT *, min(CASE WHEN capacity * weight_left <= (total - before) * weight THEN 1 ELSE 0 END)
              OVER ({by} ORDER BY capacity::DOUBLE / weight::DOUBLE, {order}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS is_full
  FROM {name}_ordered),
{name}_open AS (
  SELECT *, total - sum(capacity * is_full) OVER ({by}) AS left_over,
         greatest(sum(weight * (1 - is_full)) OVER ({by}), 1) AS open_weight
  FROM {name}_full),
{name}_parts AS (
  SELECT *, CASE WHEN is_full = 1 THEN capacity
                 ELSE (left_over * weight)::HUGEINT // open_weight::HUGEINT END AS part,
         CASE WHEN is_full = 1 THEN -1
              ELSE (left_over * weight)::HUGEINT % open_weight::HUGEINT END AS rest
  FROM {name}_open),
{name} AS (
  SELECT {order}, tokens,
         part + CASE WHEN is_full = 0
                      AND row_number() OVER ({by} ORDER BY rest DESC, {order})
                          <= total - sum(part) OVER ({by}) THEN 1 ELSE 0 END AS budget
  FROM {name}_parts)"""


_ORDER = f"md5(concat_ws('/', '{SEED}', {{epoch}}::VARCHAR, coalesce(doc_id::VARCHAR, text, '')))"

SQL["op1_source_mixing"] = f"""
WITH docs AS (
  SELECT doc_id, text, {DOMAIN} AS domain, coalesce(lang, '(none)') AS language,
         coalesce(source, '(none)') AS origin,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
leaves AS (
  SELECT domain, language, origin, sum(tokens) AS tokens FROM docs GROUP BY ALL),
{_level("domains", ["domain"], None)},
{_level("languages", ["domain", "language"], "domains")},
{_level("origins", ["domain", "language", "origin"], "languages")},
plan AS (
  SELECT domain, language, origin,
         CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END::BIGINT AS epochs,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END::BIGINT AS prefix
  FROM origins),
placed AS (
  SELECT docs.*, epochs, prefix,
         sum(tokens) OVER (PARTITION BY domain, language, origin
                           ORDER BY {_ORDER.format(epoch="epochs")}, tokens, text
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS before
  FROM docs JOIN plan USING (domain, language, origin))
SELECT doc_id, domain, language, origin, tokens, epoch::INT AS epoch, tokens AS taken
FROM placed, range({MAX_EPOCHS}) AS passes(epoch) WHERE epoch < epochs
UNION ALL
SELECT doc_id, domain, language, origin, tokens, epochs::INT,
       least(tokens, prefix - before)::BIGINT
FROM placed WHERE prefix > 0 AND before < prefix
"""

SQL["op9_vector_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_reached AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e LEFT JOIN counts c USING (vec_id) JOIN least_reached l USING (vec_id)
"""


def _by_rule(value: str) -> str:
    """A CASE over the rules, longest first."""
    ordered = sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
    cases = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{value.format(rule=r)}'"
        for r in ordered
    ]
    return f"CASE {' '.join(cases)} END"


_ROOM = math.sqrt(0.5 * math.log(2 / urls.ALPHA))


def _alike(part: str, of: str) -> str:
    return (
        f"abs(g.{part}::DOUBLE / g.{of} - b.{part}::DOUBLE / b.{of})"
        f" < {_ROOM!r} * (1.0::DOUBLE / sqrt(g.{of}) + 1.0::DOUBLE / sqrt(b.{of}))"
    )


def _url_level(k: int) -> str:
    """Branches of one level, folded one by one into groups, and the rows below them."""
    counts = ("pages", "labelled", "blocked", "ends", "numbers")
    alike = f"""CASE WHEN g.labelled > 0 AND b.labelled > 0 THEN {_alike("blocked", "labelled")}
              ELSE g.labelled = 0 AND b.labelled = 0 END
         AND {_alike("ends", "pages")} AND {_alike("numbers", "pages")}"""
    return f"""
children{k} AS MATERIALIZED (
  SELECT host, node, CASE WHEN len(segments) >= {k} THEN segments[{k}] END AS segment,
         max(pages) AS through, count(*)::BIGINT AS pages, sum(labelled::INT)::BIGINT AS labelled,
         sum(is_blocked::INT)::BIGINT AS blocked,
         sum((len(segments) <= {k})::INT)::BIGINT AS ends,
         sum((len(segments) > {k}
              AND regexp_matches(coalesce(segments[{k + 1}], ''), '^[0-9]'))::INT)::BIGINT AS numbers
  FROM rows{k - 1} GROUP BY ALL),
kept{k} AS MATERIALIZED (
  SELECT * FROM children{k} WHERE segment IS NULL
    OR (pages >= {urls.LEAST_PAGES} AND pages * {urls.LEAST_SHARE} >= through)),
branches{k} AS MATERIALIZED (
  SELECT *, row_number() OVER (
      PARTITION BY host, node
      ORDER BY labelled > 0,
               CASE WHEN ends * 2 >= pages THEN 0 WHEN numbers * 2 >= pages THEN 1 ELSE 2 END,
               CASE WHEN labelled > 0 THEN blocked::DOUBLE / labelled ELSE 0.0::DOUBLE END,
               segment) AS place
  FROM kept{k} WHERE segment IS NOT NULL),
fold{k} AS (
  SELECT host, node, place, segment, 1 AS batch, {", ".join(counts)}
  FROM branches{k} WHERE place = 1
  UNION ALL
  SELECT host, node, place, segment, CASE WHEN joins THEN batch ELSE batch + 1 END,
         {", ".join(f"CASE WHEN joins THEN g_{c} + {c} ELSE {c} END" for c in counts)}
  FROM (SELECT b.*, g.batch, {", ".join(f"g.{c} AS g_{c}" for c in counts)}, {alike} AS joins
        FROM fold{k} g JOIN branches{k} b
          ON g.host = b.host AND g.node = b.node AND b.place = g.place + 1) s),
groups{k} AS MATERIALIZED (
  SELECT host, node, batch, max(pages) AS pages, max(labelled) AS labelled,
         max(blocked) AS blocked,
         string_agg(replace(replace(segment, '*', '%2A'), '|', '%7C'), '|' ORDER BY segment) AS label
  FROM fold{k} GROUP BY ALL),
named{k} AS MATERIALIZED (
  SELECT f.host, f.node, f.segment, g.label, g.pages, g.labelled, g.blocked
  FROM fold{k} f JOIN groups{k} g USING (host, node, batch)),
sums{k} AS MATERIALIZED (
  SELECT host, node, sum(pages)::BIGINT AS pages, sum(labelled)::BIGINT AS labelled,
         sum(blocked)::BIGINT AS blocked
  FROM kept{k} GROUP BY ALL),
moved{k} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node, pages, node_labelled, node_blocked),
         r.node || CASE WHEN ended THEN '' ELSE '/' || coalesce(n.label, '*') END AS node,
         CASE WHEN ended THEN r.pages WHEN n.label IS NOT NULL THEN n.pages
              ELSE r.pages - coalesce(s.pages, 0) END AS pages,
         CASE WHEN ended THEN r.node_labelled WHEN n.label IS NOT NULL THEN n.labelled
              ELSE r.node_labelled - coalesce(s.labelled, 0) END AS node_labelled,
         CASE WHEN ended THEN r.node_blocked WHEN n.label IS NOT NULL THEN n.blocked
              ELSE r.node_blocked - coalesce(s.blocked, 0) END AS node_blocked
  FROM (SELECT *, len(segments) < {k} AS ended FROM rows{k - 1}) r
  LEFT JOIN sums{k} s ON r.host = s.host AND r.node = s.node
  LEFT JOIN named{k} n ON r.host = n.host AND r.node = n.node AND n.segment = r.segments[{k}]),
rows{k} AS MATERIALIZED (
  SELECT * EXCLUDE (purity, ended),
         CASE WHEN ended THEN purity ELSE {_smoothed("purity")} END AS purity
  FROM moved{k})"""


def _smoothed(above: str) -> str:
    return f"(node_blocked + {urls.WEIGHT!r}::DOUBLE * {above}) / (node_labelled + {urls.WEIGHT!r}::DOUBLE)"


SQL["op12_path_templates"] = f"""
WITH RECURSIVE parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                            '{urls.UPPER}', '{urls.UPPER.lower()}') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                             THEN substr(url, strpos(url, '://') + 3) END AS rest
        FROM pages) p),
judged AS MATERIALIZED (
  SELECT *, said IS NOT NULL AS labelled, coalesce(said = 'block', FALSE) AS is_blocked,
         CASE WHEN len(parts) <= {urls.DEPTH} THEN parts
              ELSE list_append(parts[1:{urls.DEPTH - 1}],
                               array_to_string(parts[{urls.DEPTH}:], '/')) END AS segments
  FROM (SELECT *, {_by_rule("{rule.host}{rule.path}")} AS rule, {_by_rule("{rule.verdict}")} AS said,
               list_filter(string_split(path, '/'), lambda x: x <> '') AS parts
        FROM parsed) p),
hosts AS (
  SELECT host, count(*)::BIGINT AS pages, sum(labelled::INT)::BIGINT AS node_labelled,
         sum(is_blocked::INT)::BIGINT AS node_blocked
  FROM judged GROUP BY host),
overall AS (
  SELECT (sum(node_blocked) + 1.0::DOUBLE) / (sum(node_labelled) + 2.0::DOUBLE) AS share FROM hosts),
rows0 AS MATERIALIZED (
  SELECT judged.*, '' AS node, pages, node_labelled, node_blocked, {_smoothed("share")} AS purity
  FROM judged JOIN hosts USING (host), overall),
{",".join(_url_level(k) for k in range(1, urls.DEPTH + 1))}
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN purity > {urls.REJECT_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
       host || CASE WHEN node = '' THEN '/' ELSE node END AS template, purity
FROM rows{urls.DEPTH}
"""


def _share(times: str, total: str) -> str:
    return f"(1 + 1000000000::HUGEINT * ({times} + 2) // ({total} + 2 * kept))"


SQL["op13_skyband_audit"] = f"""
WITH read AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.UPPER.lower()}'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
counts AS MATERIALIZED (
  SELECT lang, source, term, sum(times)::HUGEINT AS times, count(*) AS documents
  FROM (SELECT lang, source, term, count(*) AS times
        FROM (SELECT lang, source, row_number() OVER () AS row, unnest(terms) AS term FROM read) t
        GROUP BY lang, source, row, term) d
  GROUP BY lang, source, term),
vocabulary AS MATERIALIZED (
  SELECT lang, term, sum(times) AS lang_times FROM counts GROUP BY lang, term
  HAVING sum(documents) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*)::HUGEINT AS kept, sum(lang_times) AS lang_total
          FROM vocabulary GROUP BY lang),
totals AS (SELECT lang, source, sum(times) AS total
           FROM counts JOIN vocabulary USING (lang, term) GROUP BY lang, source),
groups AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(kept, 0) AS kept,
         coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM read) g
  LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, v.term, coalesce(c.times, 0) AS times,
         {_share("coalesce(c.times, 0)", "total")} AS p,
         {_share("lang_times", "lang_total")} AS q
  FROM groups g JOIN vocabulary v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
telling AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM shares WHERE times > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank
FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, rank
FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source
                                    ORDER BY value DESC, item))::INT AS rank
      FROM telling) t
WHERE rank <= {TOP}
"""

SQL["op11_seekable_infilling"] = f"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('{FIM_SEED}:' || coalesce(doc_id::VARCHAR, '')) AS hex
  FROM documents),
drawn AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(hex, 1, 8))::BIGINT AS h1,
         ('0x' || substr(hex, 9, 8))::BIGINT AS h2, ('0x' || substr(hex, 17, 8))::BIGINT AS h3,
         ('0x' || substr(hex, 25, 8))::BIGINT AS h4
  FROM lines),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix,
         array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
