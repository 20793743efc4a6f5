"""Leading directors per time window.

One query for all windows, over film rows that are joined and written once: every film gets the start of its window as a column
(windows are ``width`` years wide, anchored at the earliest year), and one
``row_number()`` per window keeps the top ``n`` directors -- no loop of jobs
from the driver, no per-window filter, and the earliest year is a lazy scalar
subquery rather than a value collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import window_label, window_start, year_in
from ..functions.literals import matches_first
from ..functions.money import exact_decimal, exact_total
from ..operators.aggregates import collect_titles
from ..operators.chunks import collect_in_chunks
from ..operators.ranking import top_n_per_group
from ..operators.reuse import written_once
from .ratings import avg_rating_per_film

#: Film means are summed as decimals with this many digits after the point (14 before it),
#: so scores do not depend on summation order and are never rounded.
SCORE_SCALE = 24
#: Winners are hinted as a broadcast only up to this many per window.
BROADCAST_N = 1000


def directors_of(credits: DataFrame, crew: str = "crew", key: str = "id",
                 department: str = "Directing", job: str | None = None) -> DataFrame:
    """(id, director_name): the first crew member of the ``department`` (and,
    when given, with that ``job``, e.g. ``"Director"``); films without one
    have no row."""
    also = {"job": job} if job is not None else None
    return (credits.select(F.col(key).alias("id"),
                           F.explode(matches_first(crew, "department", department, "name", also))
                            .alias("director_name"))
                   .where(F.col("director_name").isNotNull()))


def director_films(films: DataFrame, credits: DataFrame | None, ratings: DataFrame,
                   title: str = "title", date: str = "release_date",
                   directors: DataFrame | None = None) -> DataFrame:
    """(id, title, year, director_name, ratings): rated films with their director
    and their mean user rating. ``directors`` (id, director_name) replaces the
    default first-Directing lookup on ``credits`` when given."""
    f = films.select("id", F.col(title).alias("title"), year_in(films, date).alias("year"))
    r = avg_rating_per_film(ratings, alias="ratings").withColumnRenamed("movieid", "id")
    d = directors if directors is not None else directors_of(credits)
    return f.join(d, "id").join(r, "id")


def director_scores_by_window(df: DataFrame, width: int = 10, anchor="min") -> DataFrame:
    """(window, window_start, director_name, ratings): per window, the unweighted
    mean of the director's film means.

    Film means are first summed per (year, director) -- independent of the
    anchor and combined map-side -- so the earliest year is read from that
    small aggregate, and the windows are rolled up from it. ``anchor="calendar"``
    starts the windows at multiples of ``width`` instead; an int anchors them at
    that year.
    """
    per_year = (df.where(F.col("year").isNotNull()).groupBy("year", "director_name")
                .agg(exact_total(exact_decimal("ratings", SCORE_SCALE)).alias("_sum"),
                     F.count("ratings").alias("_n")))
    if anchor == "min":
        # the windows and the earliest year both read this small aggregate: it is written once
        per_year = written_once(per_year)
        a = per_year.select(F.min(F.when((F.col("_n") > 0) & F.col("_sum").isNotNull(),
                                         F.col("year")))).scalar()
    else:  # "calendar": windows start at multiples of width; or a given year
        a = F.lit(0 if anchor == "calendar" else int(anchor))
    w = per_year.withColumn("window_start", window_start("year", a, width))
    out = w.groupBy("window_start", "director_name").agg(
        F.try_divide(exact_total("_sum").cast("double"), F.sum("_n").cast("double")).alias("ratings"))
    return out.select(window_label("window_start", width).alias("window"),
                      "window_start", "director_name", "ratings")


def filmography(df: DataFrame) -> DataFrame:
    """(director_name, movies_directed): every title of each director, over all
    years, sorted and comma-joined.

    The joined text is one value per director, so a director's whole career
    meets in one task at the end; ``filmography_chunks`` gives texts of bounded length and
    ``filmography_rows`` the same titles one row each, with no per-director gathering at all."""
    return collect_titles(df, "director_name", "title", alias="movies_directed")


def filmography_chunks(df: DataFrame, size: int = 1000) -> DataFrame:
    """(director_name, chunk, movies_directed): the titles of ``filmography``, ``size`` to a text.

    A director with a third of all films spreads over tasks, and no value grows without bound."""
    return collect_in_chunks(df, "director_name", "title", size, alias="movies_directed")


def filmography_rows(df: DataFrame, directors: DataFrame | None = None) -> DataFrame:
    """(director_name, title): distinct titles per director, one row each,
    optionally only for the ``directors`` given (e.g. the winners)."""
    rows = df.select("director_name", "title").where(F.col("title").isNotNull())
    if directors is not None:
        rows = rows.join(directors.select("director_name").distinct(), "director_name", "left_semi")
    return rows.distinct()


def top_directors_per_window(df: DataFrame, n: int = 5, width: int = 10,
                             anchor="min") -> DataFrame:
    """(window, rank, director_name, movies_directed, ratings): the ``n`` best
    directors of each window (equal scores -> lower name first), each with the
    titles of their whole career.

    The rated film rows are written once, so films, credits and ratings are joined and the crew texts
    parsed once. Only the winners' films are collected: the film rows are semi-joined to the
    (at most n per window) winners, kept in long form (one row per director
    and title) and turned into text last. A winner without any titled film has
    an empty list.
    """
    # read by the scores, by the earliest year and by the title lists
    rated = written_once(df.where(F.col("ratings").isNotNull()).select("director_name", "title", "year", "ratings"))
    top = top_n_per_group(director_scores_by_window(rated, width, anchor), "window_start", "ratings", n,
                          tie_break="director_name")
    # At most n rows per window, and at most (year span / width + 1) windows. While n is small this
    # is hinted as a broadcast, so the film rows are filtered where they are; else AQE decides.
    hint = F.broadcast if n <= BROADCAST_N else (lambda d: d)
    winners = hint(top.select("director_name").distinct())
    titles = filmography(rated.join(winners, "director_name", "left_semi"))
    # ``rank`` carries the order inside each window; no global sort of the result
    return top.join(titles, "director_name", "left").select(
        "window", "rank", "director_name",
        F.coalesce("movies_directed", F.lit("")).alias("movies_directed"), "ratings")
