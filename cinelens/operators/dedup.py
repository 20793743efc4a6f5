"""Keyed de-duplication: the 'upsert by primary key' of a keyed store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, keys, order=(), keep: str = "first") -> DataFrame:
    """One row per key: the first (``keep='first'``) or last row in the total
    order ``(order..., every other column...)``.

    Written as ``groupBy(keys).agg(min(struct(...)))``: the aggregate is
    combined map-side, so a key holding a third of all rows is reduced to one
    row inside each map task before the shuffle. (A ``row_number() = 1``
    window gets the same effect only through Spark's partial group-limit
    rule; the aggregate does not depend on it -- see benchmarks/skew_check.py.)
    Struct values are compared field by field, so Spark runs it as a
    sort-based aggregate. Ordering on every column makes the kept row
    independent of partitioning (identical rows are interchangeable); all
    columns must be orderable (no map columns).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    order = [c for c in order if c in payload]
    ordered = order + [c for c in payload if c not in order]
    pick = F.min if keep == "first" else F.max
    row = pick(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)]))
    pos = {c: i for i, c in enumerate(ordered)}
    out = df.groupBy(*keys).agg(row.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col("_row")[f"_{pos[c]}"].alias(c)
                        for c in df.columns])
