"""Profit by production company and decade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import decade_label, year_in
from ..functions.literals import parse_names
from ..functions.money import exact_sum, profit, profit_percentage as pct
from ..operators.ranking import top_per_group


def _profitable(films: DataFrame) -> DataFrame:
    return (films.withColumn("profit", profit("revenue", "budget"))
                 .where(F.col("profit") > 0))


def profit_percentage(films: DataFrame, key: str = "id", title: str = "title") -> DataFrame:
    """(id, title, profit, profit_percentage) of the profitable films."""
    return (_profitable(films)
            .select(key, title, "profit", pct("profit", "budget").alias("profit_percentage")))


def company_profit_by_decade(films: DataFrame, companies: str = "production_companies",
                             date: str = "release_date") -> DataFrame:
    """(production_companies, decade, profit): summed profit of the profitable
    films of each company per decade. Loss-making films are excluded before the
    sum, and each listed company is credited the film's whole profit. Films
    without a date are left out. ``companies`` is an array of names or the
    stored list-of-dict text (parsed here, after the profit filter)."""
    names = F.col(companies)
    if isinstance(films.schema[companies].dataType, T.StringType):
        names = parse_names(companies)
    df = (_profitable(films).where(F.col(date).isNotNull())
          .select(F.explode(names).alias("production_companies"),
                  decade_label(year_in(films, date)).alias("decade"), "profit"))
    return df.groupBy("production_companies", "decade").agg(
        exact_sum("profit").alias("profit"))


def top_company_per_decade(by_company: DataFrame) -> DataFrame:
    """(decade, production_companies, profit): the most profitable company(ies)
    of each decade, ties kept, ordered by decade. The ranking compares the one
    evaluated (exact) sum, never two separately computed float sums."""
    top = top_per_group(by_company, "decade", "profit", broadcast_best=True)  # one row per decade
    return top.select("decade", "production_companies", "profit").orderBy("decade")
