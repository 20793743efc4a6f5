"""Cleaning the raw catalog and credits into keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import items_schema, parse_names, parse_pylist
from ..operators.dedup import dedup_by_key
from ..operators.filters import keep_valid
from ..schemas import CATALOG_COLUMNS, RAW_MOVIE_COLUMNS, RAW_MOVIE_KEYS


def clean_catalog(df: DataFrame, columns=CATALOG_COLUMNS, genres: str = "genres",
                  key: str = "id") -> DataFrame:
    """Keep the catalog columns, drop unusable films, parse genre names.

    Dropped: NULL id / genres / release_date / revenue / runtime, budget or
    revenue equal to 0 (or NULL), and an empty company list ``[]`` (or NULL).
    An empty genre list is kept (it yields no row when exploded). Genres become
    ``array<string>`` in place -- no detour through Python rows and no join
    back to the source. Runtime read as double (``81.0``) becomes int. One row
    per ``key`` survives (the keyed table's upsert), chosen by a total order.
    """
    cols = [c for c in columns if c in df.columns]
    out = keep_valid(
        df.select(*cols),
        not_null=[c for c in (key, genres, "release_date", "revenue", "runtime") if c in cols],
        not_equal={c: v for c, v in (("budget", 0), ("revenue", 0),
                                      ("production_companies", "[]")) if c in cols},
    )
    if isinstance(df.schema[genres].dataType, T.StringType):
        out = out.withColumn(genres, parse_names(genres))
    if "runtime" in cols:
        out = out.withColumn("runtime", F.col("runtime").cast("int"))
    return dedup_by_key(out, [key])


def raw_movies(df: DataFrame, columns=RAW_MOVIE_COLUMNS, keys=RAW_MOVIE_KEYS) -> DataFrame:
    """All catalog columns as they come, one row per (id, imdb_id); rows without a full key go."""
    cols = [c for c in columns if c in df.columns]
    return dedup_by_key(keep_valid(df.select(*cols), not_null=list(keys), not_equal={}), list(keys))


def clean_credits(df: DataFrame, key: str = "id") -> DataFrame:
    """Credits with cast, crew and id present and neither list empty; one row per id."""
    out = keep_valid(df, not_null=["cast", "crew", key],
                     not_equal={"cast": "[]", "crew": "[]"})
    return dedup_by_key(out, [key])


def parse_report(df: DataFrame, cols, key: str = "name") -> DataFrame:
    """One row: for each list-text column ``c``, ``c_rows`` (non-NULL texts),
    ``c_failed`` (texts that could not be read as a list of dicts -- they
    become NULL in the cleaned table) and ``c_items`` (elements read).

    A single global aggregate, combined map-side.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    # One number per text, so that each text is read once: its items, or -1 if it cannot be read.
    items = df.select(*[F.when(F.col(c).isNotNull(), F.coalesce(
        F.size(parse_pylist(c, items_schema(key))), F.lit(-1))).alias(f"_{i}")
        for i, c in enumerate(cols)])
    aggs = []
    for i, c in enumerate(cols):
        n = F.col(f"_{i}")
        aggs += [F.count(n).alias(f"{c}_rows"), F.count_if(n < 0).alias(f"{c}_failed"),
                 F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).cast("long").alias(f"{c}_items")]
    return items.agg(*aggs)
