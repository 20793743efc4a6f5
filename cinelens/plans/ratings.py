"""Average user rating per film and the top-rated film per decade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import decade_label, year_in
from ..operators.aggregates import mean_by_key
from ..operators.dedup import dedup_by_key
from ..operators.ranking import top_per_group


def avg_rating_per_film(ratings: DataFrame, key: str = "movieid", value: str = "ratings",
                        alias: str = "average_rating") -> DataFrame:
    """(movieid, average_rating): mean of the non-NULL ratings of each film.

    Grain of ``ratings`` is one row per (user, film); nothing is collapsed
    before averaging.
    """
    return mean_by_key(ratings.where(F.col(value).isNotNull()), key, value, alias)


def avg_ratings_with_title_year(ratings: DataFrame, films: DataFrame, key: str = "movieid",
                                film_key: str = "id", title: str = "title",
                                date: str = "release_date",
                                films_keyed: bool = True) -> DataFrame:
    """(movieid, title, year_of_release, average_rating) for rated films.

    ``films`` is expected to hold one row per id (the keyed table written by
    ``clean_catalog``). For raw files, where an id can repeat and would repeat
    its average, pass ``films_keyed=False``: the (id, title, date) projection
    is de-duplicated by id first (map-side combined). The averages come out of
    the aggregate hash-partitioned by film id, so the join with the films
    shuffles only the films side (or neither, when AQE finds one side small
    enough to broadcast).
    """
    avg = avg_rating_per_film(ratings, key)
    f = films.select(F.col(film_key).alias(key), title, year_in(films, date).alias("year_of_release"))
    if not films_keyed:
        f = dedup_by_key(f, [key])
    return avg.join(f, key).select(key, title, "year_of_release", "average_rating")


def top_rated_per_decade(avg_ratings: DataFrame, title: str = "title",
                         year: str = "year_of_release", value: str = "average_rating") -> DataFrame:
    """(title, highest_rating, decade): every film whose average equals the best
    average of its calendar decade (label ``1990-2000``); films without a year
    are left out."""
    df = (avg_ratings.where(F.col(year).isNotNull())
          .select(title, F.col(value).alias("highest_rating"), decade_label(year).alias("decade")))
    # one row per decade: bounded, so broadcast outright
    return top_per_group(df, "decade", "highest_rating", broadcast_best=True)
