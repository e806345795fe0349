"""For each registered query, the same result as plain SQL over the same tables."""

from __future__ import annotations

from shiftwell import catalog
from shiftwell.functions import prompts
from shiftwell.functions.vectors import TOKEN
from shiftwell.operators.models import TAG_FILLER, TAG_RULES

_DRIVERS = """people AS (
  SELECT c_custkey AS id, c_nationkey AS n_nationkey FROM customer
  UNION ALL SELECT s_suppkey + 1000000000, s_nationkey FROM supplier
), drivers AS (
  SELECT id AS Driver_ID, CAST(25 + id % 36 AS INT) AS Age, n_name AS City,
         CAST(1 + id % 20 AS INT) AS Experience_Years,
         CAST(4.0 + (id % 11) * 0.1 AS DOUBLE) AS Average_Rating
  FROM people JOIN nation USING (n_nationkey))"""

_RIDES = """rides AS (
  SELECT l_orderkey * 10 + l_linenumber AS Ride_ID, o_custkey AS Driver_ID,
         CAST(o_orderdate AS DATE) AS Date, CAST(l_quantity AS INT) AS Duration_min,
         ROUND(l_extendedprice / 1000, 2) AS Fare
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ARTICLES = """articles AS (
  SELECT 'doc-' || doc_id AS article_name, source AS city,
         DATE '2025-01-01' + CAST(doc_id % 365 AS INT) AS published, text AS content
  FROM documents)"""

_SUMMARY = f"""{_DRIVERS}, {_RIDES}, summary AS (
  SELECT d.Driver_ID, d.Age, d.City, d.Experience_Years, d.Average_Rating, r.Date,
         COUNT(r.Ride_ID) AS total_rides, ROUND(SUM(r.Fare), 2) AS total_fare,
         CAST(SUM(r.Duration_min) AS BIGINT) AS total_duration_min
  FROM drivers d LEFT JOIN rides r ON d.Driver_ID = r.Driver_ID
  GROUP BY d.Driver_ID, d.Age, d.City, d.Experience_Years, d.Average_Rating, r.Date)"""

_CORE = f"""{_SUMMARY}, core AS (
  SELECT Driver_ID AS driver_ID, Age, City, Experience_Years,
         ANY_VALUE(Average_Rating) AS Average_Rating,
         COUNT(DISTINCT Date) AS active_days,
         CAST(SUM(total_rides) AS BIGINT) AS total_rides_all_days,
         MAX(total_rides) AS max_rides, AVG(total_rides) AS avg_rides,
         MIN(total_fare) AS min_fare, MAX(total_fare) AS max_fare,
         STDDEV_SAMP(total_fare) AS stddev_fare,
         CAST(SUM(total_duration_min) AS BIGINT) AS total_duration_min_all_days
  FROM summary GROUP BY Driver_ID, Age, City, Experience_Years)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _printf(prompt: prompts.Prompt) -> str:
    """The prompt with every place filled as text; NULL if a value is."""
    return f"printf({_quoted(prompt.template)}, {', '.join(prompt.columns)})"


_CORE_COLUMNS = """SELECT driver_ID, Age, City, Experience_Years, Average_Rating, active_days,
  total_rides_all_days, max_rides, avg_rides, min_fare, max_fare,
  ROUND(stddev_fare, 6) AS stddev_fare, total_duration_min_all_days FROM core"""

_REASON = f"""'The driver gave ' || total_rides_all_days || ' rides over ' || active_days
  || ' days in ' || total_duration_min_all_days || ' minutes, a workload of '
  || CASE WHEN per_day >= {catalog.LONG_DAY} THEN 'long' ELSE 'ordinary' END
  || ' days. Earnings are '
  || CASE WHEN spread >= 0.35 THEN 'uneven' ELSE 'steady' END
  || ', so the stress level is likely '
  || CASE WHEN stress_score >= {catalog.HIGH_AT} THEN 'high' ELSE 'low' END || '.'"""

_METRICS = f"""{_CORE}, ratios AS (
  SELECT *, total_duration_min_all_days / NULLIF(active_days, 0) AS per_day,
         stddev_fare / NULLIF(max_fare, 0) AS spread FROM core
), scored AS (
  SELECT *, GREATEST(LEAST(0.45::DOUBLE * LEAST(per_day / 480, 1) + 0.35::DOUBLE * LEAST(spread, 1)
                           + 0.20::DOUBLE * (5 - Average_Rating) / 5, 1), 0) AS stress_score
  FROM ratios WHERE spread IS NOT NULL
), metrics AS (
  SELECT core.driver_ID, core.City, core.Age, scored.stress_score,
         CASE WHEN scored.driver_ID IS NOT NULL THEN {_REASON.replace("total_", "scored.total_")
         .replace("active_days", "scored.active_days")} END AS stress_reason
  FROM core LEFT JOIN scored ON core.driver_ID = scored.driver_ID)"""

_MATCHED = ", ".join(
    f"CASE WHEN contains(stress_reason, '{found}') THEN '{word}' END" for found, word in TAG_RULES
)
_FILLER = ", ".join(_quoted(word) for word in TAG_FILLER)

_TAGS = f"""{_METRICS}, words AS (
  SELECT driver_ID, stress_reason,
         list_filter([{_MATCHED}], lambda w: w IS NOT NULL) AS found FROM metrics
), tags AS (
  SELECT driver_ID, CASE WHEN stress_reason IS NOT NULL THEN array_to_string(
    list_slice(found || [{_FILLER}], 1, LEAST(GREATEST(len(found), 2), 3)), ', ')
    END AS stress_report_tags FROM words)"""


def _hash_vectors(texts: str, id_columns: str, text: str, dim: int) -> str:
    """CTEs ending in ``vectors``: one row per id and place of the hashed word counts."""
    ids = [name.strip() for name in id_columns.split(",")]
    same = " AND ".join(f"p.{name} = c.{name}" for name in ids)
    return f"""words_of AS (
  SELECT {id_columns}, unnest(regexp_extract_all(lower({text}), '{TOKEN}')) AS w FROM {texts}
), counts AS (
  SELECT {id_columns}, ('0x' || substring(md5(w), 1, 8))::BIGINT % {dim} AS b, COUNT(*) AS c
  FROM words_of GROUP BY ALL
), lengths AS (
  SELECT {id_columns}, SQRT(SUM(c * c)) AS length FROM counts GROUP BY ALL
), places AS (
  SELECT {id_columns}, CAST(unnest(range({dim})) AS INT) AS place FROM {texts}
), vectors AS (
  SELECT {", ".join("p." + name for name in ids)}, p.place,
         ROUND(COALESCE(c.c / l.length, 0), 6) AS value
  FROM places p
  LEFT JOIN counts c ON {same} AND p.place = c.b
  LEFT JOIN lengths l ON {same.replace("c.", "l.")})"""


def _hits(flag: str) -> str:
    tests = (f"CAST(contains(lower(content), {_quoted(t)}) AS INT)" for t in catalog.TERMS[flag])
    return f"({' + '.join(tests)}) >= {catalog.MIN_HITS}"


_WITH_TEXT = "FROM articles WHERE content IS NOT NULL AND content <> ''"

_FLAGS = f"""WITH {_ARTICLES} SELECT article_name, city, published,
  {", ".join(f"{_hits(flag)} AS {flag}" for flag in catalog.TERMS)} {_WITH_TEXT}"""

_RAW_ARTICLES = """raw AS (
  SELECT CASE WHEN n_chars >= 100 THEN 'doc-' || doc_id END AS article_name, source AS city,
         CASE WHEN lang = 'fr' THEN '2025-13-01' ELSE '2025-06-12' END AS published,
         text AS content, CASE WHEN source IN ('src1', 'src2') THEN lang END AS author
  FROM documents
), judged AS (
  SELECT *, concat_ws('; ',
    CASE WHEN article_name IS NULL THEN 'article_name: required' END,
    CASE WHEN TRY_CAST(published AS DATE) IS NULL THEN 'published: not of type date' END,
    CASE WHEN author IS NOT NULL THEN 'author: no such column' END) AS errors FROM raw)"""

_APPENDED = f"""WITH {_RAW_ARTICLES}
SELECT article_name, city, CAST(published AS DATE) AS published, content
FROM judged WHERE errors = ''"""

_FEED = r"""feed AS (
  SELECT 'doc-' || doc_id AS title,
         trim(regexp_replace(text, '[\x{0}-\x{9}\x{B}-\x{1F}\x{FFFE}\x{FFFF}]', ' ', 'g'), ' ' || chr(10)) AS description,
         CASE WHEN n_chars >= 100 THEN 'http://example.test/' || doc_id END AS link,
         lang = 'fr' AS undated
  FROM documents)"""

# The two main directions of the centred vectors: the covariance matrix, scaled to
# trace 1, is squared until only its first direction is left; then the same again
# with that direction taken out. Signs as in the query.
def _direction(name: str, matrix: str) -> str:
    return f"""{name}_power(k, i, j, x) AS (
  SELECT 0, i, j, x / (SELECT SUM(x) FROM {matrix} WHERE i = j) FROM {matrix}
  UNION ALL
  SELECT k, i, j, x / SUM(CASE WHEN i = j THEN x END) OVER () FROM (
    SELECT a.k + 1 AS k, a.i, b.j, SUM(a.x * b.x) AS x
    FROM {name}_power a JOIN {name}_power b ON a.j = b.i
    WHERE a.k < 20 GROUP BY a.k, a.i, b.j)
), {name}_raw AS (
  SELECT i, x / SQRT(SUM(CASE WHEN i = j THEN x END) OVER (PARTITION BY j)) AS x
  FROM {name}_power WHERE k = 20 AND j = (
    SELECT arg_max(i, x) FROM {name}_power WHERE k = 20 AND i = j)
), {name}_unit AS (
  SELECT i, x / (SELECT SQRT(SUM(x * x)) FROM {name}_raw) AS x FROM {name}_raw
), {name} AS (
  SELECT i, x * (SELECT SIGN(arg_max(x, ABS(x))) FROM {name}_unit) AS x FROM {name}_unit
)"""


_POINTS = f"""cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
  FROM embeddings
), centred AS (
  SELECT vec_id, label, i, v - AVG(v) OVER (PARTITION BY i) AS v FROM cells
), covariance AS MATERIALIZED (
  SELECT a.i, b.i AS j, SUM(a.v * b.v) / (COUNT(*) - 1) AS x
  FROM centred a JOIN centred b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
), {_direction("d1", "covariance")}, strength AS (
  SELECT SUM(a.x * c.x * b.x) AS s
  FROM covariance c JOIN d1 a ON a.i = c.i JOIN d1 b ON b.i = c.j
), rest AS MATERIALIZED (
  SELECT c.i, c.j, c.x - (SELECT s FROM strength) * a.x * b.x AS x
  FROM covariance c JOIN d1 a ON a.i = c.i JOIN d1 b ON b.i = c.j
), {_direction("d2", "rest")}, points AS (
  SELECT vec_id AS driver_ID, SUM(v * d1.x) AS x, SUM(v * d2.x) AS y, 'tag ' || label AS main_tag
  FROM centred JOIN d1 USING (i) JOIN d2 USING (i) GROUP BY vec_id, label)"""

_ITEMS = f"""WITH {_FEED}
  SELECT title, description, link, '2025-06-10T06:00:00+00:00' AS published,
         description AS summary FROM feed WHERE link IS NOT NULL AND NOT undated"""

_LITERALS = ", ".join(
    f"({_quoted(r['article_name'])}, {_quoted(r['city']) if 'city' in r else 'NULL'}, "
    f"{_quoted(r['published'])}, {_quoted(r['content'])})"
    for r in catalog.LITERALS
    if "content" in r
)

SQL: dict[str, str] = {
    "summary_drivers": f"WITH {_SUMMARY} SELECT * FROM summary",
    "summary_drivers_sorted": f"WITH {_SUMMARY} SELECT * FROM summary ORDER BY total_fare DESC",
    "drivers_metrics_core": f"WITH {_CORE} {_CORE_COLUMNS}",
    "drivers_metrics_core_count_rewrite": f"WITH {_CORE} {_CORE_COLUMNS}",
    "driver_prompts": f"""WITH {_CORE} SELECT driver_ID,
      {_printf(prompts.STRESS_SCORE)} AS score_prompt,
      {_printf(prompts.STRESS_REASON)} AS reason_prompt FROM core""",
    "article_prompts": f"""WITH {_ARTICLES} SELECT article_name, {
        ", ".join(f"{_printf(p)} AS {flag}" for flag, p in prompts.ARTICLE_QUESTIONS.items())
    } {_WITH_TEXT}""",
    "articles_nonempty": f"""WITH {_ARTICLES}
      SELECT article_name, city, published, content {_WITH_TEXT}""",
    "articles_metrics": _FLAGS,
    "articles_metrics_batch": _FLAGS,
    "model_results_struct": f"""WITH {_ARTICLES}, asked AS (
        SELECT article_name, {_hits("financial_pressure")} AS result {_WITH_TEXT})
      SELECT article_name, result, CASE WHEN result THEN 'yes' ELSE 'no' END AS full_response,
             'ok' AS status FROM asked""",
    "stress_score": f"""WITH {_METRICS}
      SELECT driver_ID, ROUND(stress_score, 6) AS stress_score FROM metrics""",
    "drivers_metrics": f"""WITH {_METRICS}
      SELECT driver_ID, City, Age, ROUND(stress_score, 6) AS stress_score, stress_reason
      FROM metrics""",
    "driver_reason_tags": f"WITH {_TAGS} SELECT driver_ID, stress_report_tags FROM tags",
    "driver_reason_tags_stored": f"WITH {_TAGS} SELECT driver_ID, stress_report_tags FROM tags",
    "driver_tag_shapes": f"""WITH {_TAGS}, keywords AS (
        SELECT driver_ID, stress_report_tags, string_split(stress_report_tags, ',') AS k FROM tags)
      SELECT driver_ID, stress_report_tags, len(k) BETWEEN 2 AND 3 AND len(list_filter(k,
        lambda w: NOT len(string_split(trim(w), ' ')) BETWEEN 1 AND 2)) = 0 AS tags_ok
      FROM keywords""",
    "distinct_tags": f"WITH {_TAGS} SELECT DISTINCT stress_report_tags FROM tags",
    "driver_main_tag": f"""WITH {_TAGS}
      SELECT driver_ID, TRIM(split_part(stress_report_tags, ',', 1)) AS main_tag FROM tags""",
    "tag_embeddings": f"""WITH {_TAGS}, texts AS (
        SELECT DISTINCT stress_report_tags FROM tags WHERE stress_report_tags IS NOT NULL),
      {_hash_vectors("texts", "stress_report_tags", "stress_report_tags", catalog.TAG_DIM)}
      SELECT stress_report_tags, place, value FROM vectors""",
    "article_embeddings": f"""WITH {_ARTICLES},
      {_hash_vectors("articles", "article_name", "content", catalog.TEXT_DIM)}
      SELECT article_name, place, value FROM vectors""",
    "embedding_points": f"""WITH RECURSIVE {_POINTS}
      SELECT driver_ID, ROUND(x, 5) AS x, ROUND(y, 5) AS y, main_tag FROM points""",
    "embedding_point_bins": f"""WITH RECURSIVE {_POINTS}
      SELECT CAST(FLOOR(x / 0.05) AS BIGINT) AS x_bin, CAST(FLOOR(y / 0.05) AS BIGINT) AS y_bin,
             main_tag, COUNT(*) AS points FROM points GROUP BY ALL""",
    "append_rejects": f"""WITH {_RAW_ARTICLES}
      SELECT article_name, errors FROM judged WHERE errors <> ''""",
    "append_articles": _APPENDED,
    "load_counts": f"""WITH {_RAW_ARTICLES}
      SELECT count_if(errors = '') AS loaded, count_if(errors <> '') AS rejected FROM judged""",
    "append_json_rejects": """SELECT 'doc-' || doc_id AS article_name,
      CASE WHEN lang = 'fr' THEN 'a name is given more than once' END AS errors FROM documents""",
    "literal_articles": f"""WITH given(article_name, city, published, content) AS (
        VALUES {_LITERALS})
      SELECT article_name, n_chars, city, CAST(published AS DATE) AS published, content
      FROM given JOIN documents ON article_name = 'doc-' || doc_id
      WHERE TRY_CAST(published AS DATE) IS NOT NULL""",
    "run_all_tags": f"""WITH {_TAGS}, {_ARTICLES}
      SELECT CAST(driver_ID AS VARCHAR) AS name, stress_report_tags FROM tags
      UNION ALL
      SELECT article_name, concat_ws(' ', {", ".join(f"{_hits(f)}" for f in catalog.TERMS)})
      {_WITH_TEXT}""",
    "drivers_metrics_batch": f"""WITH {_CORE}, prompted AS (
        SELECT *, {_printf(prompts.STRESS_SCORE)} AS s, {_printf(prompts.STRESS_REASON)} AS r
        FROM core)
      SELECT driver_ID, City, Age, (length(s) % 101) / 100::DOUBLE AS stress_score,
             'Asked in ' || length(r) || ' signs.' AS stress_reason FROM prompted""",
    "stream_append_two_sources": """SELECT event_id AS Ride_ID,
      CASE WHEN event_type = 'error' THEN 'Driver_ID: not of type bigint' ELSE '' END AS errors
      FROM events""",
    "append_articles_twice": _APPENDED,
    "upload_drivers_csv": f"""WITH {_DRIVERS}
      SELECT Driver_ID, 'Driver, ' || Driver_ID AS Name, CAST(Age AS BIGINT) AS Age, City,
             CAST(Experience_Years AS BIGINT) AS Experience_Years, Average_Rating,
             CASE WHEN Age > 40 THEN 'Active' END AS Active_Status FROM drivers""",
    "replace_rides": f"""WITH {_RIDES}
      SELECT Ride_ID, Driver_ID, CAST(NULL AS VARCHAR) AS City, Date,
             CAST(NULL AS DOUBLE) AS Distance_km, CAST(Duration_min AS BIGINT) AS Duration_min,
             Fare, CAST(NULL AS DOUBLE) AS Rating, CAST(NULL AS VARCHAR) AS Promo_Code FROM rides""",
    "replace_under_reader": f"""WITH {_RIDES}
      SELECT Ride_ID, Fare, 'before' AS seen FROM rides
      UNION ALL SELECT Ride_ID, Fare * 2, 'after' FROM rides WHERE Duration_min > 25""",
    "view_over_tables": f"""WITH {_DRIVERS}, {_RIDES}
      SELECT d.City, COUNT(r.Ride_ID) AS rides, ROUND(SUM(r.Fare), 2) AS fare
      FROM drivers d LEFT JOIN rides r ON d.Driver_ID = r.Driver_ID GROUP BY d.City""",
    "stream_append": """SELECT event_id AS Ride_ID, user_id AS Driver_ID, CAST(ts AS DATE) AS Date,
             value AS Fare FROM events WHERE event_type <> 'error'""",
    "feed_items": _ITEMS,
    "feed_table": _ITEMS,
    "feed_rejects": f"""WITH {_FEED}
      SELECT title, concat_ws('; ', CASE WHEN link IS NULL THEN 'link: required' END,
             CASE WHEN undated THEN 'published: not a date' END) AS errors
      FROM feed WHERE link IS NULL OR undated""",
}

SQL["embedding_crowded_bins"] = f"""
WITH points AS (
  SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label::VARCHAR AS main_tag
  FROM embeddings),
frame AS (SELECT min(x) AS x0, min(y) AS y0, greatest(max(x) - min(x), max(y) - min(y)) AS side
          FROM points),
fine AS (
  SELECT least(floor((x - x0) / side * 4096.0::DOUBLE)::BIGINT, 4095) AS fx,
         least(floor((y - y0) / side * 4096.0::DOUBLE)::BIGINT, 4095) AS fy, main_tag
  FROM points, frame),
around AS (
  SELECT level::INT AS level, fx >> (12 - level) AS x_cell, fy >> (12 - level) AS y_cell, main_tag
  FROM fine, range(13) AS levels(level)),
nodes AS (SELECT level, x_cell, y_cell, count(*) AS points FROM around GROUP BY ALL),
met AS (
  SELECT n.*, a.points AS outer_points
  FROM nodes n LEFT JOIN nodes a
    ON a.level = n.level - 1 AND a.x_cell = n.x_cell >> 1 AND a.y_cell = n.y_cell >> 1),
cells AS (
  SELECT power, level, x_cell, y_cell
  FROM met, (SELECT 1::BIGINT << k::INT AS power FROM range(40) AS powers(k)) p
  WHERE (outer_points IS NULL OR outer_points > power) AND NOT (points > power AND level < 12)),
chosen AS (
  SELECT min(power) AS power
  FROM (SELECT power FROM cells GROUP BY power HAVING count(*) <= {catalog.PLOT_CELLS}) c)
SELECT level, x_cell, y_cell, main_tag, count(*) AS points
FROM around JOIN cells USING (level, x_cell, y_cell) JOIN chosen USING (power)
GROUP BY ALL"""
SQL["stream_driver_metrics"] = f"WITH {_CORE} {_CORE_COLUMNS}"
SQL["stream_feed"] = SQL["feed_table"]
SQL["stream_feed_rejects"] = SQL["feed_rejects"]

_EMBEDDED = f"""WITH {_TAGS}, texts AS (
    SELECT driver_ID, stress_report_tags FROM tags WHERE stress_report_tags IS NOT NULL),
  {_hash_vectors("texts", "driver_ID, stress_report_tags", "stress_report_tags", catalog.TAG_DIM)}
  SELECT driver_ID, stress_report_tags, place, value FROM vectors"""
SQL["driver_reason_embeddings"] = _EMBEDDED
SQL["driver_reason_embeddings_batch"] = _EMBEDDED
SQL["driver_reason_embeddings_stored"] = _EMBEDDED
