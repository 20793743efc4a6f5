"""Profit arithmetic and order-independent sums / means.

Floating-point sums depend on the order rows are added, which on a cluster
depends on partitioning. Values are therefore summed exactly, in any order, and only
the final value is cast to double. A mean is then ``double(exact sum) / count`` -- one IEEE
division, so equal true means compare equal (ties are found exactly).

A value with at most four digits after the point and below 10^11 -- prices, ratings, counts --
is an integer number of ten-thousandths; it is split into a high and a low limb, and both are
summed as longs. (Such a spelling has at most 15 digits, and no two of those share a double, so
dividing back tells whether it is the value's shortest spelling.) All other values are summed
as wide decimals. Both sums meet once per group.

A value is taken as its shortest decimal form (what it prints as). One that
does not fit the decimal -- too large, too fine, NaN or infinite -- raises, and
so does a sum that outgrows it; nothing is rounded or left out, with ANSI mode
on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal digits after the point; 38 - SCALE digits remain before it.
SCALE = 18


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def profit(revenue="revenue", budget="budget") -> Column:
    """revenue - budget (NULL when either is NULL)."""
    return _c(revenue) - _c(budget)


def profit_percentage(profit_col="profit", budget="budget") -> Column:
    """profit / budget * 100; NULL (not an error) when budget is 0."""
    return F.try_divide(_c(profit_col), _c(budget)) * F.lit(100.0)


def exact_decimal(c, scale: int = SCALE) -> Column:
    """The value as ``decimal(38, scale)``; raises if it does not survive the cast."""
    c = _c(c)
    wide = c.try_cast(f"decimal(38,{scale})")
    fits = wide.isNotNull() & (wide.cast("double") == c.cast("double"))
    return F.when(c.isNull() | fits, wide).otherwise(F.raise_error(F.concat(
        F.lit(f"value does not fit decimal(38,{scale}): "), c.cast("string"))))


def exact_total(c) -> Column:
    """Sum of a decimal column; raises on overflow instead of giving NULL."""
    c = _c(c)
    total = F.try_sum(c)
    return F.when(total.isNotNull() | (F.count(c) == 0), total).otherwise(
        F.raise_error(F.lit("sum does not fit a 38-digit decimal")))


#: Digits after the point of values summed as integers, and where those end.
FINE, _MOST = 4, 10 ** 15
#: Bits of the low limb: sums of 2^37 rows still fit a long.
_LIMB = 24


def exact_sum(c, scale: int = SCALE) -> Column:
    """Sum of a column, exact, as double; raises if the sum needs more than a 38-digit decimal
    (37 digits where both kinds of values meet in a group)."""
    c = _c(c)
    x = c.cast("double")
    units = F.rint(x * F.lit(float(10 ** FINE)))
    fine = (F.abs(units) < F.lit(float(_MOST))) & (units / F.lit(float(10 ** FINE)) == x)
    whole = F.when(fine, units.cast("long"))
    high = F.try_sum(F.shiftright(whole, _LIMB))
    low = F.try_sum(whole.bitwiseAND(F.lit((1 << _LIMB) - 1)))
    coarse = F.when(~fine, exact_decimal(c, scale))
    n_fine, n_coarse = F.count(whole), F.count(coarse)
    tens = high.cast("decimal(20,0)") * F.lit(1 << _LIMB).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    fine_sum = tens * F.lit(10 ** -FINE).cast(f"decimal({FINE},{FINE})")
    coarse_sum = F.try_sum(coarse)
    both = fine_sum.try_cast(f"decimal(37,{scale})") + coarse_sum.try_cast(f"decimal(37,{scale})")
    total = F.when(n_coarse == 0, fine_sum.try_cast(f"decimal(38,{scale})")).when(n_fine == 0, coarse_sum).otherwise(
        both.try_cast(f"decimal(38,{scale})"))
    return F.when(total.isNotNull() | (n_fine + n_coarse == 0), total).otherwise(
        F.raise_error(F.lit("sum does not fit a 38-digit decimal"))).cast("double")


def exact_mean(c, scale: int = SCALE) -> Column:
    """Mean ignoring NULLs (like ``avg``), from an exact sum."""
    return F.try_divide(exact_sum(c, scale), F.count(_c(c)).cast("double"))


def exact_sum_sql(x: str, scale: int = SCALE) -> str:
    """SQL text of ``exact_sum`` over the SQL expression ``x``."""
    kind, unit = f"DECIMAL(38,{scale})", f"{10 ** FINE}.0D"
    units = f"rint(CAST(({x}) AS DOUBLE) * {unit})"
    fine = f"(abs({units}) < {_MOST}.0D AND {units} / {unit} = CAST(({x}) AS DOUBLE))"
    whole = f"CASE WHEN {fine} THEN CAST({units} AS BIGINT) END"
    value = (f"CASE WHEN NOT {fine} THEN CASE WHEN CAST(try_cast(({x}) AS {kind}) AS DOUBLE) = CAST(({x}) AS DOUBLE) "
             f"THEN try_cast(({x}) AS {kind}) ELSE "
             f"raise_error(concat('value does not fit {kind}: ', CAST(({x}) AS STRING))) END END")
    fine_sum = (f"(CAST(try_sum(shiftright({whole}, {_LIMB})) AS DECIMAL(20,0)) * CAST({1 << _LIMB} AS DECIMAL(8,0)) "
                f"+ CAST(try_sum(({whole}) & {(1 << _LIMB) - 1}) AS DECIMAL(20,0))) * CAST(0.0001 AS DECIMAL({FINE},{FINE}))")
    total = (f"CASE WHEN count({value}) = 0 THEN try_cast({fine_sum} AS {kind}) "
             f"WHEN count({whole}) = 0 THEN try_sum({value}) "
             f"ELSE try_cast(try_cast({fine_sum} AS DECIMAL(37,{scale})) + try_cast(try_sum({value}) AS DECIMAL(37,{scale})) "
             f"AS {kind}) END")
    return (f"CAST(CASE WHEN ({total}) IS NOT NULL OR count({whole}) + count({value}) = 0 THEN ({total}) "
            "ELSE raise_error('sum does not fit a 38-digit decimal') END AS DOUBLE)")


def exact_mean_sql(x: str, scale: int = SCALE) -> str:
    return f"try_divide({exact_sum_sql(x, scale)}, CAST(COUNT({x}) AS DOUBLE))"
