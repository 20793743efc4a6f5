"""

``entry(spark)`` runs the flagship query (top-rated film per decade, ties
kept) on /root/testdata/sf0.001; ``queries()`` maps every registered query to
a ``(spark, sf_dir) -> DataFrame`` callable; ``oracle_sql()`` gives, for each
of them, an independent DuckDB SQL formulation over the raw driver tables.

The SQL rebuilds the film-shaped views from the raw tables itself (it does
not share code with the Spark side). Sums of money and ratings are
summed by the decimal spelling of each value; means are ``double(sum) / count``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinelens.queries import QUERIES, TABLES  # noqa: E402

# The training-data operators are optional: their folder, the pipeline or a library they need may be absent.
_LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_ORACLE: dict[str, str] = {}

try:
    from cinelens.llm.queries import ORACLE_SQL as _SQL, QUERIES as _OWN
    _LLM_QUERIES.update(_OWN)
    _LLM_ORACLE.update(_SQL)
except ImportError as _why:
    print(f"training-data queries are left out: {_why}", file=sys.stderr)
else:
    try:
        import corpus_pipeline
        _LLM_QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            _LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as _why:
        print(f"query pipeline is left out: {_why}", file=sys.stderr)

FLAGSHIP = "top_rated_per_decade"


def entry(spark: SparkSession) -> DataFrame:
    return QUERIES[FLAGSHIP](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_LLM_QUERIES}


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB). Shared CTE pieces first.

def _sum(x: str, scale: int = 18) -> str:
    """Sum of a DOUBLE column by its values' decimal spelling; out-of-range values are an error."""
    return (f"CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,{scale}))) AS VARCHAR) "
            "AS DOUBLE)")


_FILMS_BASE = """
films_base AS (
  SELECT o_orderkey AS id,
         'Order#' || CAST(o_orderkey AS VARCHAR) AS title,
         CAST(o_orderdate AS DATE) AS release_date,
         o_totalprice AS budget,
         o_orderpriority AS original_language
  FROM orders)"""

_LINE_AGG = """
line_agg AS (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))
                  * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
         CAST(MAX(l_quantity) AS INTEGER) AS runtime,
         SUM(l_quantity) AS popularity,
         COUNT(*) AS vote_count
  FROM lineitem GROUP BY l_orderkey)"""

_FILMS = _FILMS_BASE + "," + _LINE_AGG + """,
films AS (
  SELECT b.*, a.revenue, a.runtime, a.popularity, a.vote_count
  FROM films_base b LEFT JOIN line_agg a ON b.id = a.l_orderkey)"""

_GENRE_PAIRS = """
genre_pairs AS (
  SELECT DISTINCT l.l_orderkey AS id, p.p_type AS genre
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

_COMP_PAIRS = """
comp_pairs AS (
  SELECT DISTINCT l.l_orderkey AS id, s.s_name, s.s_suppkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

_LINES = """
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, s.s_name, l.l_returnflag, l.l_linestatus
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

_DIRECTORS = _LINES + """,
directors AS (
  SELECT id, director_name FROM (
    SELECT l_orderkey AS id, s_name AS director_name,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, s_name, l_linestatus) AS rn
    FROM lines WHERE l_returnflag = 'R') t
  WHERE rn = 1 AND director_name IS NOT NULL)"""

_RATING_AVG = f"""
rating_avg AS (
  SELECT l_orderkey AS movieid,
         {_sum('(l_quantity / 10.0)')} / COUNT(l_quantity) AS average_rating
  FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_orderkey)"""

_AVG_WITH_TITLE = _FILMS_BASE + "," + _RATING_AVG + """,
avg_ratings AS (
  SELECT r.movieid, f.title, CAST(year(f.release_date) AS INTEGER) AS year_of_release,
         r.average_rating
  FROM rating_avg r JOIN films_base f ON r.movieid = f.id)"""


def _decade_label(y: str) -> str:
    return (f"CAST({y} - {y} % 10 AS VARCHAR) || '-' || "
            f"CAST({y} - {y} % 10 + 10 AS VARCHAR)")


_DIRECTOR_FILMS = _FILMS_BASE + "," + _DIRECTORS + "," + _RATING_AVG + """,
df AS (
  SELECT f.id, f.title, CAST(year(f.release_date) AS INTEGER) AS year,
         d.director_name, r.average_rating AS ratings
  FROM films_base f JOIN directors d ON f.id = d.id JOIN rating_avg r ON f.id = r.movieid)"""


def _director_scores(width: int) -> str:
    return _DIRECTOR_FILMS + f""",
scores AS (
  SELECT ws AS window_start, director_name, {_sum('ratings', 24)} / count(ratings) AS ratings
  FROM (SELECT director_name, ratings,
               CAST((SELECT min(year) FROM df)
                    + floor((year - (SELECT min(year) FROM df)) / {width}) * {width} AS INTEGER) AS ws
        FROM df WHERE year IS NOT NULL) t
  GROUP BY ws, director_name),
scored AS (
  SELECT CAST(window_start AS VARCHAR) || '-' || CAST(window_start + {width - 1} AS VARCHAR) AS "window",
         window_start, director_name, ratings FROM scores)"""


def _top_directors(width: int, n: int = 5) -> str:
    return "WITH " + _director_scores(width) + f""",
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                                    ORDER BY ratings DESC, director_name) AS INTEGER) AS "rank"
  FROM scored),
top AS (SELECT * FROM ranked WHERE "rank" <= {n}),
titles AS (
  SELECT director_name, array_to_string(list_sort(list(DISTINCT title)), ',') AS movies_directed
  FROM df WHERE title IS NOT NULL AND director_name IN (SELECT director_name FROM top)
  GROUP BY director_name)
SELECT t."window", t."rank", t.director_name, coalesce(ti.movies_directed, '') AS movies_directed,
       t.ratings
FROM top t LEFT JOIN titles ti ON t.director_name = ti.director_name"""


_ORACLE = {
    "clean_catalog": "WITH " + _FILMS + "," + _GENRE_PAIRS + "," + _COMP_PAIRS + """,
genre_agg AS (SELECT id, to_json(list(genre ORDER BY genre)) AS genres
              FROM genre_pairs GROUP BY id),
comp_agg AS (
  SELECT id, '[' || string_agg('{''name'': ''' || s_name || ''', ''id'': '
                               || CAST(s_suppkey AS VARCHAR) || '}', ', '
                               ORDER BY s_name, s_suppkey) || ']' AS production_companies
  FROM comp_pairs GROUP BY id)
SELECT f.budget, g.genres, f.id, f.original_language, f.popularity, c.production_companies,
       f.release_date, f.revenue, f.runtime, f.title, f.vote_count
FROM films f JOIN genre_agg g ON f.id = g.id JOIN comp_agg c ON f.id = c.id
WHERE f.budget <> 0 AND f.revenue <> 0 AND f.runtime IS NOT NULL
  AND f.release_date IS NOT NULL AND c.production_companies <> '[]'""",

    "clean_credits": "WITH " + _LINES + """,
cr AS (
  SELECT l_orderkey AS id,
         '[' || coalesce(string_agg('{''cast_id'': ' || CAST(l_linenumber AS VARCHAR)
                                    || ', ''name'': ''' || s_name || '''}', ', '
                                    ORDER BY l_linenumber, s_name, l_returnflag, l_linestatus)
                         FILTER (WHERE l_linestatus = 'O'), '') || ']' AS "cast",
         '[' || string_agg(CASE WHEN l_returnflag = 'R'
                   THEN '{''department'': ''Directing'', ''job'': ''Director'', ''name'': '''
                        || s_name || '''}'
                   ELSE '{''department'': ''Crew'', ''job'': None, ''name'': '''
                        || s_name || '''}' END, ', '
                   ORDER BY l_linenumber, s_name, l_returnflag, l_linestatus) || ']' AS crew
  FROM lines GROUP BY l_orderkey)
SELECT id, "cast", crew FROM cr
WHERE "cast" IS NOT NULL AND crew IS NOT NULL AND "cast" <> '[]' AND crew <> '[]'""",

    "catalog_parse_report": "WITH " + _GENRE_PAIRS + "," + _COMP_PAIRS + """
SELECT (SELECT COUNT(DISTINCT id) FROM genre_pairs) AS genres_text_rows,
       CAST(0 AS BIGINT) AS genres_text_failed,
       (SELECT COUNT(*) FROM genre_pairs) AS genres_text_items,
       (SELECT COUNT(DISTINCT id) FROM comp_pairs) AS production_companies_rows,
       CAST(0 AS BIGINT) AS production_companies_failed,
       (SELECT COUNT(*) FROM comp_pairs) AS production_companies_items""",

    "parse_report_with_failures": "WITH " + _GENRE_PAIRS + """,
n AS (SELECT l_orderkey AS id, COUNT(*) % 2 = 0 AS cut FROM lineitem GROUP BY l_orderkey),
g AS (SELECT n.id, n.cut, COUNT(p.genre) AS items FROM n LEFT JOIN genre_pairs p ON n.id = p.id
      GROUP BY n.id, n.cut)
SELECT COUNT(*) AS genres_text_rows,
       COUNT(*) FILTER (WHERE cut) AS genres_text_failed,
       CAST(coalesce(SUM(items) FILTER (WHERE NOT cut), 0) AS BIGINT) AS genres_text_items
FROM g""",

    "text_date_parts": """
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) - year(o_orderdate) % 10 AS INTEGER) AS decade
FROM orders""",

    "titles_by_popularity": "WITH " + _FILMS + """
SELECT title, runtime FROM films ORDER BY popularity DESC NULLS LAST, id""",

    "dedup_by_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS rn
      FROM lineitem) t
WHERE rn = 1""",

    "null_audit": "WITH " + _FILMS + """
SELECT COUNT(*) AS row_count,
       COUNT(*) FILTER (WHERE id IS NULL) AS id_nulls,
       COUNT(*) FILTER (WHERE title IS NULL) AS title_nulls,
       COUNT(*) FILTER (WHERE release_date IS NULL) AS release_date_nulls,
       COUNT(*) FILTER (WHERE budget IS NULL) AS budget_nulls,
       COUNT(*) FILTER (WHERE revenue IS NULL) AS revenue_nulls,
       COUNT(*) FILTER (WHERE runtime IS NULL) AS runtime_nulls,
       COUNT(*) FILTER (WHERE popularity IS NULL) AS popularity_nulls,
       COUNT(*) FILTER (WHERE vote_count IS NULL) AS vote_count_nulls
FROM films""",

    "parse_names_exploded": "WITH " + _COMP_PAIRS + """
SELECT id, s_name AS company FROM comp_pairs""",

    "first_matching_member": "WITH " + _DIRECTORS + """
SELECT id, director_name FROM directors""",

    "avg_rating_per_film": "WITH " + _RATING_AVG + """
SELECT movieid, average_rating FROM rating_avg""",

    "avg_ratings_with_title_year": "WITH " + _AVG_WITH_TITLE + """
SELECT movieid, title, year_of_release, average_rating FROM avg_ratings""",

    "top_rated_per_decade": "WITH " + _AVG_WITH_TITLE + f""",
d AS (SELECT title, average_rating AS highest_rating, {_decade_label('year_of_release')} AS decade
      FROM avg_ratings WHERE year_of_release IS NOT NULL AND average_rating IS NOT NULL)
SELECT title, highest_rating, decade FROM (
  SELECT *, rank() OVER (PARTITION BY decade ORDER BY highest_rating DESC) AS rk FROM d) t
WHERE rk = 1""",

    "genre_counts_by_decade": "WITH " + _FILMS_BASE + "," + _GENRE_PAIRS + f"""
SELECT g.genre, {_decade_label('year(f.release_date)')} AS decade, COUNT(*) AS count
FROM genre_pairs g JOIN films_base f ON g.id = f.id
WHERE f.release_date IS NOT NULL
GROUP BY 1, 2""",

    "genre_counts_from_stored_catalog": "WITH " + _FILMS + "," + _GENRE_PAIRS + "," + _COMP_PAIRS + f""",
clean AS (
  SELECT f.id, f.release_date FROM films f
  WHERE f.budget <> 0 AND f.revenue <> 0 AND f.runtime IS NOT NULL AND f.release_date IS NOT NULL
    AND f.id IN (SELECT id FROM genre_pairs) AND f.id IN (SELECT id FROM comp_pairs))
SELECT g.genre, {_decade_label('year(c.release_date)')} AS decade, COUNT(*) AS count
FROM genre_pairs g JOIN clean c ON g.id = c.id
GROUP BY 1, 2""",

    "top_genre_per_decade": "WITH " + _FILMS_BASE + "," + _GENRE_PAIRS + f""",
c AS (SELECT g.genre, {_decade_label('year(f.release_date)')} AS decade, COUNT(*) AS count
      FROM genre_pairs g JOIN films_base f ON g.id = f.id
      WHERE f.release_date IS NOT NULL GROUP BY 1, 2)
SELECT genre, decade, count FROM (
  SELECT *, rank() OVER (PARTITION BY decade ORDER BY count DESC) AS rk FROM c) t
WHERE rk = 1""",
}

_COMPANY_PROFIT = "WITH " + _FILMS + "," + _COMP_PAIRS + f""",
cp AS (
  SELECT c.s_name AS production_companies,
         {_decade_label('year(f.release_date)')} AS decade,
         {_sum('(f.revenue - f.budget)')} AS profit
  FROM films f JOIN comp_pairs c ON f.id = c.id
  WHERE f.revenue - f.budget > 0 AND f.release_date IS NOT NULL
  GROUP BY 1, 2)"""

_IN_RANGE = "WITH " + _FILMS + """,
r AS (
  SELECT id,
         CAST(year(release_date) AS INTEGER) AS year,
         CAST(month(release_date) AS INTEGER) AS month,
         revenue - budget AS profit
  FROM films
  WHERE budget <> 0 AND revenue <> 0
    AND year(release_date) >= 2000 AND year(release_date) < 2019)"""


def _longest(src: str) -> str:
    return src + """
SELECT title, popular, language, max_runtime FROM (
  SELECT original_language AS language,
         max(runtime) OVER (PARTITION BY original_language) AS max_runtime,
         max(popularity) OVER (PARTITION BY original_language) AS popular,
         title, runtime,
         row_number() OVER (PARTITION BY original_language
                            ORDER BY runtime DESC NULLS LAST, title) AS rn
  FROM src) t
WHERE rn = 1"""


_ORACLE.update({
    "company_profit_by_decade": _COMPANY_PROFIT + """
SELECT production_companies, decade, profit FROM cp""",

    "top_company_per_decade": _COMPANY_PROFIT + """
SELECT decade, production_companies, profit FROM (
  SELECT *, rank() OVER (PARTITION BY decade ORDER BY profit DESC) AS rk FROM cp) t
WHERE rk = 1""",

    "profit_percentage": "WITH " + _FILMS + """
SELECT id, title, revenue - budget AS profit,
       (revenue - budget) / budget * 100.0 AS profit_percentage
FROM films WHERE revenue - budget > 0""",

    "avg_profit_by_year_month": _IN_RANGE + f"""
SELECT {_sum('profit')} / COUNT(id) AS average_profit,
       year, month
FROM r GROUP BY year, month""",

    "month_ranking": _IN_RANGE + f""",
m AS (SELECT month, {_sum('profit')} / COUNT(id) AS average_profit
      FROM r GROUP BY month)
SELECT month, average_profit,
       CAST(rank() OVER (ORDER BY average_profit DESC) AS INTEGER) AS "rank"
FROM m""",

    "votes_by_decade": "WITH " + _FILMS + f"""
SELECT {_sum('vote_count')} / COUNT(vote_count) AS votes,
       CAST(year(release_date) - year(release_date) % 10 AS INTEGER) AS decade
FROM films GROUP BY 2""",

    "releases_by_decade": "WITH " + _FILMS_BASE + """
SELECT COUNT(title) AS movie_count,
       CAST(year(release_date) - year(release_date) % 10 AS INTEGER) AS decades
FROM films_base GROUP BY 2""",

    "longest_per_language": _longest("WITH " + _FILMS + """,
src AS (SELECT title, original_language, runtime, popularity FROM films)"""),

    "longest_document_per_language": _longest("""WITH
src AS (SELECT CAST(doc_id AS VARCHAR) AS title, lang AS original_language,
               n_chars AS runtime, CAST(n_chars AS DOUBLE) AS popularity
        FROM documents)"""),

    "year_span": "WITH " + _FILMS_BASE + """
SELECT CAST(min(year(release_date)) AS INTEGER) AS min_year,
       CAST(max(year(release_date)) AS INTEGER) AS max_year
FROM films_base""",

    "director_scores_by_window": "WITH " + _director_scores(10) + """
SELECT "window", window_start, director_name, ratings FROM scored""",

    "top_directors_per_window": _top_directors(10),

    "top_directors_per_2y_window": _top_directors(2),

    "filmography": "WITH " + _DIRECTOR_FILMS + """
SELECT director_name, array_to_string(list_sort(list(DISTINCT title)), ',') AS movies_directed
FROM df GROUP BY director_name""",

    "filmography_rows": "WITH " + _DIRECTOR_FILMS + """
SELECT DISTINCT director_name, title FROM df WHERE title IS NOT NULL""",

    "row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
})


_CUT = """
raw AS (
  SELECT f.id, f.budget, f.original_language, f.popularity, f.release_date, f.revenue, f.runtime, f.vote_count,
         'The "' || f.title || '",' || chr(10) || 'a film' AS title,
         coalesce(f.vote_count % 7 = 0, false) AS bad_id, coalesce(f.vote_count % 5 = 0, false) AS bad_date,
         coalesce(f.vote_count % 3 = 0, false) AS cut
  FROM films f)"""

_ORACLE.update({
    "filmography_chunks": "WITH " + _DIRECTOR_FILMS + """,
t AS (SELECT DISTINCT director_name, title FROM df WHERE title IS NOT NULL),
n AS (SELECT *, (row_number() OVER (PARTITION BY director_name ORDER BY title) - 1) // 25 AS chunk FROM t)
SELECT director_name, chunk, string_agg(title, ',' ORDER BY title) AS movies_directed
FROM n GROUP BY director_name, chunk""",

    "keyed_upsert": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY l_partkey, l_suppkey
      ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) t
WHERE rn = 1""",

    "catalog_from_raw_csv": "WITH " + _FILMS + "," + _GENRE_PAIRS + "," + _COMP_PAIRS + "," + _CUT + """,
genre_agg AS (SELECT id, to_json(list(genre ORDER BY genre)) AS genres FROM genre_pairs GROUP BY id),
comp_agg AS (
  SELECT id, '[' || string_agg('{''name'': ''' || s_name || ''', ''id'': ' || CAST(s_suppkey AS VARCHAR) || '}', ', '
                               ORDER BY s_name, s_suppkey) || ']' AS production_companies
  FROM comp_pairs GROUP BY id)
SELECT r.budget, CASE WHEN NOT r.cut THEN g.genres END AS genres, r.id, r.original_language, r.popularity,
       c.production_companies, r.release_date, r.revenue, CAST(r.runtime AS INTEGER) AS runtime, r.title, r.vote_count
FROM raw r JOIN genre_agg g ON r.id = g.id JOIN comp_agg c ON r.id = c.id
WHERE r.budget <> 0 AND r.revenue <> 0 AND r.runtime IS NOT NULL AND r.release_date IS NOT NULL
  AND c.production_companies <> '[]' AND NOT r.bad_id AND NOT r.bad_date""",

    "raw_csv_rejects": "WITH " + _FILMS + "," + _CUT + """
SELECT CASE WHEN NOT bad_id THEN id END AS id, title,
       concat_ws('; ', CASE WHEN bad_id THEN 'id: tt' || CAST(id AS VARCHAR) END,
                 CASE WHEN bad_date THEN 'release_date: 2001-13-45' END) AS problems,
       CASE WHEN bad_id THEN 'tt' ELSE '' END || CAST(id AS VARCHAR) AS raw_id
FROM raw WHERE bad_id OR bad_date""",

    "raw_csv_counts": "WITH " + _FILMS + "," + _CUT + """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE bad_id OR bad_date) AS rejected, CAST(0 AS BIGINT) AS bad_record,
       COUNT(*) FILTER (WHERE bad_id) AS bad_id, COUNT(*) FILTER (WHERE bad_date) AS bad_release_date,
       CAST(0 AS BIGINT) AS bad_runtime,
       COUNT(*) FILTER (WHERE NOT bad_id AND NOT bad_date AND vote_count IS NOT NULL) AS genres_rows,
       COUNT(*) FILTER (WHERE NOT bad_id AND NOT bad_date AND cut) AS genres_failed
FROM raw""",

    "genre_counts_from_bridge": _ORACLE["genre_counts_by_decade"],
    "company_profit_from_bridge": _ORACLE["company_profit_by_decade"],
    "top_directors_from_bridge": _ORACLE["top_directors_per_window"],
})


# The SQL-text forms answer the same questions as their DataFrame twins.
for _k in ("avg_ratings_with_title_year", "avg_profit_by_year_month", "votes_by_decade",
           "releases_by_decade", "longest_per_language"):
    _ORACLE[_k + "_sql"] = _ORACLE[_k]


# Reports written as CSV and read back hold the rows of the report.
for _k, _report in (("genre_counts_csv", "genre_counts_by_decade"),
                    ("votes_csv_single_file", "votes_by_decade"),
                    ("directors_csv_by_window", "top_directors_per_2y_window")):
    _ORACLE[_k] = _ORACLE[_report]


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _ORACLE.items() if k in QUERIES}, **_LLM_ORACLE}
