"""Per-decade trends and the longest film per language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import decade_start, year_in
from ..functions.money import exact_mean
from ..operators.aggregates import longest_by, trend


def votes_by_decade(films: DataFrame, votes: str = "vote_count",
                    date: str = "release_date") -> DataFrame:
    """(votes, decade): mean vote count per calendar decade, ascending; films
    without a date form the NULL decade."""
    df = films.select(votes, decade_start(year_in(films, date)).alias("decade"))
    return trend(df, "decade", [exact_mean(votes).alias("votes")]).select("votes", "decade")


def releases_by_decade(films: DataFrame, title: str = "title",
                       date: str = "release_date") -> DataFrame:
    """(movie_count, decades): number of titled films per calendar decade."""
    df = films.select(title, decade_start(year_in(films, date)).alias("decades"))
    return trend(df, "decades", [F.count(title).alias("movie_count")]).select("movie_count", "decades")


def longest_per_language(films: DataFrame, language: str = "original_language",
                         runtime: str = "runtime", title: str = "title",
                         popularity: str = "popularity") -> DataFrame:
    """(title, popular, language, max_runtime), longest runtime first.

    ``title`` is the film holding the language's longest runtime (equal
    runtimes -> smallest title); ``popular`` is the language's highest
    popularity, independent of that film.
    """
    out = longest_by(films.select(language, runtime, title, popularity),
                     language, runtime, title, also_max=[popularity])
    return (out.select(title, F.col(popularity).alias("popular"),
                       F.col(language).alias("language"), F.col(runtime).alias("max_runtime"))
               .orderBy(F.col("max_runtime").desc_nulls_last(), "language"))
