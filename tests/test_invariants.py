"""Invariants on the driver tables (sf0.001) and the driver contract."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cinelens import plans as P
from cinelens import queries as Q
from cinelens.sources import fixtures as fx

from paths import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["title", "highest_rating", "decade"]
    assert df.count() > 0


def test_genre_total_equals_exploded_rows(spark):
    films = fx.films(spark, SF001, ["id", "release_date", "genres"])
    exploded = films.where(F.col("release_date").isNotNull()).select(F.explode("genres")).count()
    total = P.genre_counts_by_decade(films).agg(F.sum("count")).first()[0]
    assert total == exploded


def test_top_company_dominates_its_decade(spark):
    by = Q.company_profit_by_decade(spark, SF001)
    top = {r.decade: r.profit for r in P.top_company_per_decade(by).collect()}
    for r in by.collect():
        assert r.profit <= top[r.decade]


def test_top_directors_at_most_n_per_window(spark):
    out = Q.top_directors_per_2y_window(spark, SF001)
    counts = [r["count"] for r in out.groupBy("window").count().collect()]
    assert counts and max(counts) <= 5


def test_one_row_per_decade(spark):
    for q in (Q.votes_by_decade, Q.releases_by_decade):
        df = q(spark, SF001)
        key = [c for c in df.columns if c.startswith("decade")][0]
        assert df.count() == df.select(key).distinct().count()


def test_dedup_idempotent_and_unique(spark):
    once = Q.dedup_by_key(spark, SF001)
    assert once.count() == once.select("l_orderkey", "l_linenumber").distinct().count()
    twice = Q.dedup_by_key_op(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_ratings_grain_is_user_and_film(spark):
    r = fx.ratings(spark, SF001, with_user=True)
    assert r.columns == ["userid", "movieid", "ratings"]
    assert r.count() == spark.read.parquet(f"{SF001}/lineitem.parquet").count()


def test_every_query_has_named_unique_columns(spark):
    for name, q in E.queries().items():
        cols = q(spark, SF001).columns
        assert len(cols) == len(set(cols)), name
        assert not any("(" in c or c.startswith("_") for c in cols), (name, cols)
