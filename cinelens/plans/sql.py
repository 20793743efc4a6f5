"""The questions the source wrote as SQL text, as Spark SQL over temp views.

Same semantics as the DataFrame plans (``plans.ratings``, ``plans.profit``,
``plans.trends``); Catalyst produces the same physical plan either way, so
teams that keep their reports as SQL files lose nothing. ``register_films`` names the view; the
queries are templates over that name. They expect ``release_date`` as a DATE
column (the DataFrame plans also accept ``yyyy-mm-dd`` text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.money import exact_mean_sql, exact_sum_sql

AVG_PROFIT_BY_YEAR_MONTH = """
SELECT try_divide(""" + exact_sum_sql("revenue - budget") + """,
                  CAST(COUNT(id) AS DOUBLE)) AS average_profit,
       year(release_date) AS year,
       month(release_date) AS month
FROM {films}
WHERE budget <> 0 AND revenue <> 0
  AND release_date >= make_date({start}, 1, 1) AND release_date < make_date({end}, 1, 1)
GROUP BY year(release_date), month(release_date)
ORDER BY year DESC, month
"""

VOTES_BY_DECADE = """
SELECT """ + exact_mean_sql("vote_count") + """ AS votes,
       CAST(year(release_date) - pmod(year(release_date), 10) AS INT) AS decade
FROM {films}
GROUP BY 2
ORDER BY decade NULLS FIRST
"""

RELEASES_BY_DECADE = """
SELECT COUNT(title) AS movie_count,
       CAST(year(release_date) - pmod(year(release_date), 10) AS INT) AS decades
FROM {films}
GROUP BY 2
ORDER BY decades NULLS FIRST
"""

LONGEST_PER_LANGUAGE = """
SELECT min(named_struct('u', runtime IS NULL, 'k', -runtime, 'n', title IS NULL, 't', title)).t AS title,
       max(popularity) AS popular,
       original_language AS language,
       max(runtime) AS max_runtime
FROM {films}
GROUP BY original_language
ORDER BY max_runtime DESC NULLS LAST, language
"""


AVG_RATINGS_WITH_TITLE_YEAR = """
SELECT r.movieid, f.title, year(f.release_date) AS year_of_release, r.average_rating
FROM (SELECT movieid,
             """ + exact_mean_sql("ratings") + """ AS average_rating
      FROM {ratings}
      WHERE ratings IS NOT NULL
      GROUP BY movieid) r
JOIN {films} f ON r.movieid = f.id
"""


def register_films(films: DataFrame, view: str = "films") -> str:
    films.createOrReplaceTempView(view)
    return view


def avg_profit_by_year_month(spark: SparkSession, view: str, start: int = 2000,
                             end: int = 2019) -> DataFrame:
    return spark.sql(AVG_PROFIT_BY_YEAR_MONTH.format(films=view, start=int(start), end=int(end)))


def votes_by_decade(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(VOTES_BY_DECADE.format(films=view))


def releases_by_decade(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(RELEASES_BY_DECADE.format(films=view))


def longest_per_language(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(LONGEST_PER_LANGUAGE.format(films=view))


def avg_ratings_with_title_year(spark: SparkSession, ratings_view: str,
                                films_view: str) -> DataFrame:
    return spark.sql(AVG_RATINGS_WITH_TITLE_YEAR.format(ratings=ratings_view, films=films_view))
