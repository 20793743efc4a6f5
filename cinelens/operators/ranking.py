"""Best-per-group and top-N-per-group.

Best-per-group (all ties kept) is an aggregate and a join back: the maximum of
each group is a map-side-combined ``groupBy().max()``; rows equal to it are
found by an equi-join on (group, value). The per-group table has one row per
group, so AQE broadcasts it when it measures it small and the rows never
shuffle; otherwise the join is hash-partitioned on (group, value), which keeps
a large group spread out, and AQE splits what is still skewed. No task ever
holds a whole group, even when a third of all rows tie at the top of one.

Top-N is a ``row_number()`` window filtered on the rank. Spark plans that
filter with a partial ``WindowGroupLimit`` *before* the shuffle: each map task
keeps only its own first ``n`` rows per group, so a reducer receives at most
``n`` x tasks rows for any group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def top_per_group(df: DataFrame, group, value: str, broadcast_best: bool = False) -> DataFrame:
    """All rows whose ``value`` equals the maximum of their group (ties kept).

    Rows with a NULL ``value`` never win; a NULL group is a group of its own.
    ``df`` is read twice (for the maxima and for the rows), so ``value`` must
    evaluate identically both times: a stored column, a count, or an exact
    sum/mean (``functions.money``). A floating-point sum recomputed from
    shuffle blocks fetched in another order can differ in the last bit and
    lose its tie.

    ``broadcast_best`` hints the per-group maxima as a broadcast. Only for
    groups bounded by construction (decades, windows): then the rows are
    matched in place whatever order the stages finish in, instead of relying
    on AQE to measure the maxima before the rows' shuffle would run.
    """
    keys = _list(group)
    # the maximum is taken over whole rows (value first), so both branches read the same columns
    # and Spark can reuse what lies below them
    rest = [c for c in df.columns if c not in keys and c != value]
    whole = F.max(F.when(F.col(value).isNotNull(), F.struct(value, *rest)))
    best = (df.groupBy(*keys).agg(whole[value].alias("_best"))
              .select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_best"))
    if broadcast_best:
        best = F.broadcast(best)
    cond = reduce(lambda a, b: a & b,
                  [df[k].eqNullSafe(best[f"_g{i}"]) for i, k in enumerate(keys)]
                  + [df[value] == best["_best"]])
    return df.join(best, cond, "inner").select(*df.columns)


def top_n_per_group(df: DataFrame, group, value: str, n: int, tie_break=(),
                    rank_col: str = "rank") -> DataFrame:
    """At most ``n`` rows per group: highest ``value`` first, equal values
    ordered by the ``tie_break`` columns ascending (so a tie at rank ``n`` keeps
    the lower name). Adds ``rank_col`` (1..n)."""
    order = [F.col(value).desc()] + [F.col(c).asc() for c in _list(tie_break)]
    w = Window.partitionBy(*_list(group)).orderBy(*order)
    return (df.where(F.col(value).isNotNull())
              .withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n))
