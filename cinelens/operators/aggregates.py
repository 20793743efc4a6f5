"""Grouped aggregates: means, trends, arg-max by value, list explode/collect.

All of them are ``groupBy().agg()`` with built-in aggregate functions, so Spark
runs a partial aggregate in every map task (map-side combine) and shuffles at
most one row per key per task -- a hot key does not concentrate raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import SCALE, exact_mean


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def mean_by_key(df: DataFrame, key, value: str, alias: str = "average",
                scale: int = SCALE) -> DataFrame:
    """Mean of ``value`` per key, NULLs ignored, exact (decimal) accumulation."""
    return df.groupBy(*_list(key)).agg(exact_mean(value, scale).alias(alias))


def trend(df: DataFrame, keys, aggs, order=None, descending: bool = False) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` then sort by ``order`` (default: the keys).

    The sort runs on the aggregated rows only (one per key)."""
    keys = _list(keys)
    out = df.groupBy(*keys).agg(*aggs)
    order = _list(order) if order else keys
    cols = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()
            for c in order]
    return out.orderBy(*cols)


def longest_by(df: DataFrame, key: str, value: str, title: str, also_max=(),
               key_alias: str | None = None) -> DataFrame:
    """Per ``key``: max of ``value``, the ``title`` of the row holding it
    (equal values -> the smallest title, so the answer is deterministic) and
    independent maxima of the ``also_max`` columns.

    A NULL title only wins if no row with that value has one; NULL values rank
    below all others, so a key without any value still names its smallest title.

    The arg-max is the ``min`` of a struct -- an ordinary aggregate, so it is
    combined map-side like ``max``.
    """
    pick = F.min(F.struct(F.col(value).isNull().alias("u"), (-F.col(value)).alias("k"),
                          F.col(title).isNull().alias("n"), F.col(title).alias("t")))
    aggs = [pick["t"].alias(title), F.max(value).alias(value)]
    aggs += [F.max(c).alias(c) for c in _list(also_max)]
    out = df.groupBy(key).agg(*aggs)
    return out.withColumnRenamed(key, key_alias) if key_alias else out


def explode_list(df: DataFrame, list_col: str, alias: str, keep=None) -> DataFrame:
    """One row per list element (empty or NULL list -> no row)."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != list_col]
    return df.select(*keep, F.explode(list_col).alias(alias))


def category_counts(df: DataFrame, list_col: str, alias: str, group, count_alias: str = "count") -> DataFrame:
    """Explode a list column and count rows per (element, group...)."""
    group = _list(group)
    # ``list_col`` may be computed: as a transform it is exploded as it stands, without the filter on
    # its size for which the optimizer would compute it a second time
    ex = df.select(*group, F.explode(F.transform(list_col, lambda x: x)).alias(alias))
    return ex.groupBy(alias, *group).agg(F.count(F.col(alias)).alias(count_alias))


def collect_titles(df: DataFrame, key: str, title: str, alias: str = "titles",
                   sep: str = ",") -> DataFrame:
    """Per key: the distinct titles, sorted, joined with ``sep``.

    Repeats are dropped in long form first (one row per key and title, spread
    over both); only the output value itself (one text per key) is assembled in
    one place.
    """
    rows = df.select(key, title).distinct()  # collect_list leaves NULL titles out
    lists = rows.groupBy(key).agg(F.array_sort(F.collect_list(title)).alias(alias))
    return lists.where(F.size(alias) > 0).withColumn(alias, F.array_join(alias, sep))
