"""Row filters and NULL accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_valid(df: DataFrame, not_null=(), not_equal: dict | None = None,
               extra=None) -> DataFrame:
    """Keep rows whose ``not_null`` columns are set and whose ``not_equal``
    columns differ from the given literal.

    ``col != lit`` is three-valued: a NULL in such a column drops the row too.
    One conjunctive predicate, so Catalyst pushes the simple parts into the
    parquet scan.
    """
    conds = [F.col(c).isNotNull() for c in not_null]
    conds += [F.col(c) != F.lit(v) for c, v in (not_equal or {}).items()]
    if extra is not None:
        conds.append(extra)
    if not conds:
        return df
    return df.where(reduce(lambda a, b: a & b, conds))


def null_audit(df: DataFrame, cols=None) -> DataFrame:
    """One row: number of rows and number of NULLs per column (``<col>_nulls``).

    A single global aggregate with map-side partial counts; nothing but one
    row per task reaches the final reducer.
    """
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"{c}_nulls") for c in cols]
    return df.agg(*aggs)
