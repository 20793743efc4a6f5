"""Bridge tables: list-valued texts opened once at ingest, one row per list element.

``crew_bridge`` and ``names_bridge`` read the text of a film's list once and keep every element with
its position. The questions on directors, genres and companies then run as plain joins and
aggregates over (film id, position, name, ...), without any parsing; stored with ``store_bridge``
bucketed on the film id, the joins with a film table bucketed alike need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import decade_label, year_in
from ..functions.literals import items_schema, parse_pylist
from ..functions.money import exact_sum, profit


def _elements(df: DataFrame, text: str, fields, key: str) -> DataFrame:
    # as a transform the list is exploded as it stands, without a filter on its size
    items = F.transform(parse_pylist(text, items_schema(*fields)), lambda x: x)
    opened = df.select(F.col(key).alias("id"), F.posexplode(items).alias("position", "_item"))
    return opened.select("id", "position", *[F.col("_item")[f].alias(f) for f in fields])


def crew_bridge(credits: DataFrame, crew: str = "crew", key: str = "id") -> DataFrame:
    """(id, position, name, department, job): one row per crew member."""
    return _elements(credits, crew, ("name", "department", "job"), key)


def names_bridge(films: DataFrame, text: str, key: str = "id") -> DataFrame:
    """(id, position, name): one row per element of a list of named things."""
    return _elements(films, text, ("name",), key)


def store_bridge(df: DataFrame, path: str, table: str | None = None, buckets: int | None = None,
                 key: str = "id", sort=("id", "position")) -> DataFrame:
    """Write rows sorted by film (a bucketed catalog table with ``table`` and ``buckets``) and return them as stored."""
    spark = df.sparkSession
    if table:
        df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(*sort).option(
            "path", path).format("parquet").saveAsTable(table)
        return spark.table(table)
    df.repartition(F.col(key)).sortWithinPartitions(*sort).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def directors_from_bridge(crew: DataFrame, department: str = "Directing", job: str | None = None) -> DataFrame:
    """(id, director_name): the first crew member of the department (and job); the smallest position
    per film is a map-side-combined minimum. Equal to ``directors_of`` on the text."""
    hit = F.col("department") == department
    if job is not None:
        hit = hit & (F.col("job") == job)
    first = crew.where(hit).groupBy("id").agg(F.min(F.struct("position", "name")).alias("_first"))
    return first.select("id", F.col("_first.name").alias("director_name")).where("director_name IS NOT NULL")


def genre_counts_from_bridge(films: DataFrame, genres: DataFrame, date: str = "release_date") -> DataFrame:
    """(genre, decade, count) of ``genre_counts_by_decade``, from the genre rows."""
    dated = films.where(F.col(date).isNotNull()).select("id", decade_label(year_in(films, date)).alias("decade"))
    return genres.join(dated, "id").groupBy(F.col("name").alias("genre"), "decade").agg(
        F.count("name").alias("count"))


def company_profit_from_bridge(films: DataFrame, companies: DataFrame, date: str = "release_date") -> DataFrame:
    """(production_companies, decade, profit) of ``company_profit_by_decade``, from the company rows."""
    gains = films.select("id", F.col(date).alias("_date"), profit().alias("profit"),
                         decade_label(year_in(films, date)).alias("decade")).where("profit > 0 AND _date IS NOT NULL")
    return companies.join(gains, "id").groupBy(F.col("name").alias("production_companies"), "decade").agg(
        exact_sum("profit").alias("profit"))
