"""Genre counts per decade and the leading genre of each decade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import decade_label, year_in
from ..functions.literals import parse_bracket_list
from ..operators.aggregates import category_counts
from ..operators.ranking import top_per_group


def genre_counts_by_decade(films: DataFrame, genres: str = "genres",
                           date: str = "release_date") -> DataFrame:
    """(genre, decade, count): films per genre and calendar decade.

    ``genres`` may be an array or its stored ``[A, B]`` text. Films without a
    date are left out; an empty genre list contributes nothing.
    """
    g = F.col(genres)
    if isinstance(films.schema[genres].dataType, T.StringType):
        g = parse_bracket_list(genres)
    df = (films.where(F.col(date).isNotNull())
          .select(g.alias("_g"), decade_label(year_in(films, date)).alias("decade")))
    return category_counts(df, "_g", "genre", "decade")


def top_genre_per_decade(counts: DataFrame) -> DataFrame:
    """(genre, decade, count) of the most frequent genre(s) per decade, ties kept."""
    return top_per_group(counts, "decade", "count", broadcast_best=True)  # one row per decade
