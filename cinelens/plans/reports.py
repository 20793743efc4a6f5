"""Small whole-table reports: year span and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import year_in


def year_span(films: DataFrame, date: str = "release_date") -> DataFrame:
    """One row (min_year, max_year) -- a global aggregate, combined map-side."""
    y = year_in(films, date)
    return films.agg(F.min(y).alias("min_year"), F.max(y).alias("max_year"))


def row_counts(tables: dict) -> DataFrame:
    """(table_name, row_count) for each named DataFrame: one global count each,
    unioned (a parquet count scans with an empty read schema: no column data; read by
    ``sources.read_table_footers`` it is taken from the files' footers)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
