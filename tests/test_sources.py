"""CSV reading with declared schemas, writers, keyed tables."""

import os
import tempfile

from cinelens import plans as P
from cinelens.sources import (read_catalog_csv, read_credits_csv, to_store_text, write_csv,
                              write_keyed_table)

HEADER = ("adult,belongs_to_collection,budget,genres,homepage,id,imdb_id,original_language,"
          "original_title,overview,popularity,poster_path,production_companies,"
          "production_countries,release_date,revenue,runtime,spoken_languages,status,tagline,"
          "title,video,vote_average,vote_count\n")


def _row(i, budget, genres, overview, companies, runtime, title):
    return (f'False,,{budget},"{genres}",,{i},tt{i},en,{title},"{overview}",1.5,,"{companies}",'
            f'"[]",1995-10-30,500.0,{runtime},"[]",Released,,{title},False,7.7,5415\n')


def _scratch():
    return tempfile.mkdtemp(prefix="cinelens-test-")


def test_catalog_csv_quotes_newlines_and_runtime(spark):
    d = _scratch()
    p = os.path.join(d, "movies.csv")
    with open(p, "w") as f:
        f.write(HEADER)
        f.write(_row(1, 100.0, "[{'id': 16, 'name': 'Animation'}]", "line one\nline two",
                     "[{'name': 'Pixar', 'id': 3}]", "81.0", "Toy"))
        f.write(_row(2, 50.0, "[{'id': 35, 'name': 'Comedy'}]", 'say ""hi""',
                     "[{'name': \"\"O'Neil, A\"\", 'id': 4}]", "104", "Other"))
    df = read_catalog_csv(spark, p)
    rows = {r.id: r for r in df.collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1].overview == "line one\nline two"
    assert rows[1].runtime == 81.0
    assert rows[2].overview == 'say "hi"'
    clean = {r.id: r for r in P.clean_catalog(df).collect()}
    assert clean[1].genres == ["Animation"] and clean[1].runtime == 81
    assert clean[2].genres == ["Comedy"]
    assert clean[2].production_companies == "[{'name': \"O'Neil, A\", 'id': 4}]"


def test_credits_csv(spark):
    d = _scratch()
    p = os.path.join(d, "credits.csv")
    with open(p, "w") as f:
        f.write("cast,crew,id\n")
        f.write("\"[{'name': 'A'}]\",\"[{'department': 'Directing', 'job': 'Director', 'name': 'D'}]\",7\n")
        f.write("[],\"[{'department': 'Directing', 'name': 'D'}]\",8\n")
    got = [r.id for r in P.clean_credits(read_credits_csv(spark, p)).collect()]
    assert got == [7]


def test_write_csv_single_and_partitioned(spark):
    d = _scratch()
    df = spark.createDataFrame([("1990-1999", "a", 1.0), ("2000-2009", "b", 2.0)],
                               "window string, name string, score double")
    write_csv(df, os.path.join(d, "single"), single=True)
    parts = [f for f in os.listdir(os.path.join(d, "single")) if f.startswith("part-")]
    assert len(parts) == 1
    write_csv(df, os.path.join(d, "by_window"), partition_by="window")
    assert sorted(x for x in os.listdir(os.path.join(d, "by_window")) if x.startswith("window=")) == [
        "window=1990-1999", "window=2000-2009"]


def test_keyed_table_upsert_and_store_text(spark):
    d = _scratch()
    df = spark.createDataFrame([(1, ["A", "B"], 2.0), (1, ["A"], 1.0), (2, [], 3.0)],
                               "id int, genres array<string>, v double")
    path = os.path.join(d, "movies_etl")
    write_keyed_table(to_store_text(df), path, ["id"], order=["v"], keep="last")
    back = {r.id: (r.genres, r.v) for r in spark.read.parquet(path).collect()}
    assert back == {1: ('["A","B"]', 2.0), 2: ("[]", 3.0)}


def test_keyed_write_refuses_merges_and_replays(spark):
    import pytest
    path = os.path.join(_scratch(), "t")

    def rows(*data):
        return spark.createDataFrame(data, "id int, v string")

    def stored():
        return sorted((r.id, r.v) for r in spark.read.parquet(path).collect())

    write_keyed_table(rows((1, "a"), (2, "b")), path, "id")
    with pytest.raises(FileExistsError):
        write_keyed_table(rows((3, "c")), path, "id")
    assert stored() == [(1, "a"), (2, "b")]
    for _ in range(2):  # a replayed upsert changes nothing more
        write_keyed_table(rows((2, "B"), (3, "c")), path, "id", mode="upsert")
        assert stored() == [(1, "a"), (2, "B"), (3, "c")]
    write_keyed_table(rows((9, "z")), path, "id", mode="overwrite")
    assert stored() == [(9, "z")]


def test_declared_driver_schemas_match_files(spark):
    from pyspark.sql.types import _parse_datatype_string
    from cinelens.schemas import DRIVER_TABLES
    for sf in ("0.001", "0.01", "0.1"):
        for name, ddl in DRIVER_TABLES.items():
            inferred = spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet").schema
            declared = _parse_datatype_string(ddl)
            assert [(f.name, f.dataType) for f in inferred] == \
                   [(f.name, f.dataType) for f in declared], (sf, name)


def test_bucketed_keyed_tables_join_without_shuffle(spark):
    from cinelens import plans as P
    from cinelens.sources import fixtures as fx
    d = _scratch()
    sf = "/root/testdata/sf0.001"
    films = fx.films(spark, sf, ["id", "title", "release_date"])
    avg = P.avg_rating_per_film(fx.ratings(spark, sf)).withColumnRenamed("movieid", "id")
    write_keyed_table(films, os.path.join(d, "films"), ["id"], table="t_films", buckets=4)
    write_keyed_table(avg, os.path.join(d, "avg"), ["id"], table="t_avg", buckets=4,
                      assume_unique=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force a shuffle join
    try:
        joined = spark.table("t_films").join(spark.table("t_avg"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == avg.join(films, "id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS t_films")
        spark.sql("DROP TABLE IF EXISTS t_avg")
