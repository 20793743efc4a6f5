"""Average profit by release year and month, and the ranking of months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_in, year_in
from ..functions.money import exact_sum, profit


def _mean_profit() -> Column:
    """sum(profit) / count(id): the films of the group with an id are counted."""
    return F.try_divide(exact_sum("profit"), F.count("_id").cast("double"))


def _in_range(films: DataFrame, start: int, end: int, date: str, key: str = "id") -> DataFrame:
    """Films with budget and revenue set and non-zero, start <= year < end.

    On a DATE column the year range is stated as a date range, which Spark
    pushes into the parquet scan (row groups outside it are skipped); text
    dates are compared by their year.
    """
    y = year_in(films, date)
    if isinstance(films.schema[date].dataType, T.DateType):
        in_range = ((F.col(date) >= F.lit(f"{int(start):04d}-01-01").cast("date"))
                    & (F.col(date) < F.lit(f"{int(end):04d}-01-01").cast("date")))
    else:
        in_range = (y >= start) & (y < end)
    return (films.where((F.col("budget") != 0) & (F.col("revenue") != 0) & in_range)
                 .select(F.col(key).alias("_id"), y.alias("year"),
                         month_in(films, date).alias("month"),
                         profit("revenue", "budget").alias("profit")))


def avg_profit_by_year_month(films: DataFrame, start: int = 2000, end: int = 2019,
                             date: str = "release_date") -> DataFrame:
    """(average_profit, year, month) for start <= year < end, newest year first.

    The mean is an exact sum of profits over the film count of the month.
    """
    df = _in_range(films, start, end, date)
    out = df.groupBy("year", "month").agg(_mean_profit().alias("average_profit"))
    return out.select("average_profit", "year", "month").orderBy(F.col("year").desc(), "month")


def month_ranking(films: DataFrame, start: int = 2000, end: int = 2019,
                  date: str = "release_date") -> DataFrame:
    """(month, average_profit, rank): calendar months ranked by the mean profit of
    the films released in them (all years of the range pooled), best first.

    At most 12 rows reach the window, so its single partition is bounded.
    """
    df = _in_range(films, start, end, date)
    per = df.groupBy("month").agg(_mean_profit().alias("average_profit"))
    w = Window.orderBy(F.col("average_profit").desc())
    return per.withColumn("rank", F.rank().over(w)).orderBy("rank", "month")
