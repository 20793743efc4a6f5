"""End to end: raw CSV files -> keyed tables -> CSV answers."""

import csv
import glob
import os
import tempfile

from cinelens.jobs import run
from cinelens.sources import read_keyed

HEADER = ["adult", "belongs_to_collection", "budget", "genres", "homepage", "id", "imdb_id",
          "original_language", "original_title", "overview", "popularity", "poster_path",
          "production_companies", "production_countries", "release_date", "revenue", "runtime",
          "spoken_languages", "status", "tagline", "title", "video", "vote_average", "vote_count"]


def movie(i, date, budget, revenue, genres, companies, runtime="90.0", lang="en", title=None):
    row = dict.fromkeys(HEADER, "")
    row.update(adult="False", budget=budget, genres=genres, id=i, imdb_id=f"tt{i}",
               original_language=lang, original_title=title or f"m{i}", overview="x\ny",
               popularity="1.5", production_companies=companies, production_countries="[]",
               release_date=date, revenue=revenue, runtime=runtime, status="Released",
               title=title or f"m{i}", video="False", vote_average="7.0", vote_count="10")
    return row


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, header, quoting=csv.QUOTE_MINIMAL)
        w.writeheader()
        w.writerows(rows)


def read_out(path):
    rows = []
    for p in sorted(glob.glob(os.path.join(path, "**", "part-*.csv"), recursive=True)):
        with open(p) as f:
            rows += [tuple(r) for r in csv.reader(f)]
    return sorted(rows)


def test_jobs_chain(spark):
    d = tempfile.mkdtemp(prefix="cinelens-jobs-")
    g = "[{'id': 18, 'name': 'Drama'}]"
    c = "[{'name': 'Studio A', 'id': 1}]"
    write(os.path.join(d, "movies.csv"), HEADER, [
        movie(1, "1994-05-01", "100", "300", g, c),
        movie(2, "1995-06-01", "100", "150", g, "[{'name': \"O'Neil, B\", 'id': 2}]"),
        movie(3, "2001-06-01", "100", "0", g, c),                 # revenue 0: dropped
        movie(4, "2003-02-01", "50", "80", "[]", c, runtime="120"),
    ])
    crew = "[{'department': 'Directing', 'job': 'Director', 'name': '%s'}]"
    write(os.path.join(d, "credits.csv"), ["cast", "crew", "id"], [
        {"cast": "[{'name': 'A'}]", "crew": crew % "Ann", "id": 1},
        {"cast": "[{'name': 'A'}]", "crew": crew % "Bob", "id": 2},
        {"cast": "[{'name': 'A'}]", "crew": crew % "Ann", "id": 4},
    ])
    write(os.path.join(d, "ratings.csv"), ["userid", "movieid", "ratings", "timestamp"], [
        {"userid": 1, "movieid": 1, "ratings": 4.0, "timestamp": 1},
        {"userid": 1, "movieid": 1, "ratings": 5.0, "timestamp": 2},   # same user again: latest wins
        {"userid": 2, "movieid": 1, "ratings": 3.0, "timestamp": 1},
        {"userid": 1, "movieid": 2, "ratings": 4.0, "timestamp": 1},
        {"userid": 1, "movieid": 4, "ratings": 2.5, "timestamp": 1},
    ])
    wh, out = os.path.join(d, "wh"), os.path.join(d, "out")
    run(spark, ["ingest-catalog", "--csv", f"{d}/movies.csv", "--out", f"{wh}/movies_etl"])
    run(spark, ["ingest-credits", "--csv", f"{d}/credits.csv", "--out", f"{wh}/credits"])
    run(spark, ["ingest-ratings", "--csv", f"{d}/ratings.csv", "--out", f"{wh}/ratings"])
    run(spark, ["average-ratings", "--catalog", f"{wh}/movies_etl", "--ratings", f"{wh}/ratings",
                "--out", f"{wh}/avg_ratings"])
    run(spark, ["top-rated", "--avg-ratings", f"{wh}/avg_ratings", "--out", f"{out}/top_rated"])
    assert read_out(f"{out}/top_rated") == [("m1", "4.0", "1990-2000"), ("m2", "4.0", "1990-2000"),
                                           ("m4", "2.5", "2000-2010")]
    run(spark, ["directors", "--catalog", f"{wh}/movies_etl", "--credits", f"{wh}/credits",
                "--ratings", f"{wh}/ratings", "--out", f"{out}/directors", "--n", "1"])
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/directors/window=*")) == [
        "window=1994-2003"]
    assert read_out(f"{out}/directors") == [("1", "Bob", "m2", "4.0")]
    run(spark, ["companies", "--catalog", f"{wh}/movies_etl", "--out", f"{out}/companies"])
    assert read_out(f"{out}/companies") == [("1990-2000", "Studio A", "200.0"),
                                           ("2000-2010", "Studio A", "30.0")]
    run(spark, ["longest-running", "--catalog", f"{wh}/movies_etl", "--out", f"{out}/longest"])
    assert read_out(f"{out}/longest") == [("m4", "1.5", "en", "120")]
    run(spark, ["genres", "--catalog", f"{wh}/movies_etl", "--out", f"{out}/genres"])
    assert read_out(f"{out}/genres") == [("Drama", "1990-2000", "2")]
    # single-file reports: one part file each, rows in report order
    for job, want in (("top-genres", [("Drama", "1990-2000", "2")]),
                      ("movies-trend", [("2", "1990"), ("1", "2000")]),
                      ("votes-trend", [("10.0", "1990"), ("10.0", "2000")]),
                      ("profit-month", [("30.0", "2003", "2")])):
        run(spark, [job, "--catalog", f"{wh}/movies_etl", "--out", f"{out}/{job}"])
        parts = glob.glob(f"{out}/{job}/part-*.csv")
        assert len(parts) == 1, job
        with open(parts[0]) as f:
            assert [tuple(r) for r in csv.reader(f)] == want, job


def test_readme_library_example(spark):
    d = tempfile.mkdtemp(prefix="cinelens-readme-")
    g, c = "[{'id': 18, 'name': 'Drama'}]", "[{'name': 'Studio A', 'id': 1}]"
    write(os.path.join(d, "movies_metadata.csv"), HEADER, [
        movie(1, "1994-05-01", "100", "300", g, c), movie(2, "2003-06-01", "100", "150", g, c)])
    crew = "[{'department': 'Directing', 'job': 'Director', 'name': 'Ann'}]"
    write(os.path.join(d, "credits.csv"), ["cast", "crew", "id"],
          [{"cast": "[{'name': 'A'}]", "crew": crew, "id": i} for i in (1, 2)])
    write(os.path.join(d, "ratings.csv"), ["userid", "movieid", "ratings", "timestamp"],
          [{"userid": 1, "movieid": i, "ratings": 4.0, "timestamp": 1} for i in (1, 2)])

    from cinelens import plans as P
    from cinelens.sources import (read_catalog_csv, read_credits_csv, read_ratings_csv,
                                  write_keyed_table)
    movies = P.clean_catalog(read_catalog_csv(spark, f"{d}/movies_metadata.csv"))
    credits = P.clean_credits(read_credits_csv(spark, f"{d}/credits.csv"))
    ratings = read_ratings_csv(spark, f"{d}/ratings.csv")
    avg = P.avg_ratings_with_title_year(ratings, movies)
    assert P.top_rated_per_decade(avg).count() == 2
    top = P.top_directors_per_window(P.director_films(movies, credits, ratings), n=5, width=10)
    assert [(r.director_name, r.movies_directed) for r in top.collect()] == [("Ann", "m1,m2")]
    assert P.top_company_per_decade(P.company_profit_by_decade(movies)).count() == 2
    assert P.avg_profit_by_year_month(movies, 2000, 2019).count() == 1
    write_keyed_table(movies, f"{d}/warehouse/movies_etl", keys=["id"])
    assert spark.read.parquet(os.path.join(d, "warehouse/movies_etl")).count() == 2


def test_jobs_with_bucketed_tables(spark):
    d = tempfile.mkdtemp(prefix="cinelens-jobs-b-")
    g, c = "[{'id': 18, 'name': 'Drama'}]", "[{'name': 'Studio A', 'id': 1}]"
    write(os.path.join(d, "movies.csv"), HEADER, [movie(1, "1994-05-01", "100", "300", g, c),
                                                  movie(2, "1996-05-01", "100", "150", g, c)])
    write(os.path.join(d, "ratings.csv"), ["userid", "movieid", "ratings", "timestamp"],
          [{"userid": 1, "movieid": 1, "ratings": 4.0, "timestamp": 1},
           {"userid": 1, "movieid": 2, "ratings": 3.0, "timestamp": 1}])
    try:
        run(spark, ["ingest-catalog", "--csv", f"{d}/movies.csv", "--out", f"{d}/wh/movies",
                    "--table", "jb_movies", "--buckets", "4"])
        run(spark, ["ingest-ratings", "--csv", f"{d}/ratings.csv", "--out", f"{d}/wh/ratings",
                    "--table", "jb_ratings", "--buckets", "4"])
        run(spark, ["average-ratings", "--catalog", "jb_movies", "--ratings", "jb_ratings",
                    "--out", f"{d}/wh/avg", "--table", "jb_avg", "--buckets", "4"])
        run(spark, ["top-rated", "--avg-ratings", "jb_avg", "--out", f"{d}/out/top"])
        assert read_out(f"{d}/out/top") == [("m1", "4.0", "1990-2000")]
    finally:
        for t in ("jb_movies", "jb_ratings", "jb_avg"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_raw_movies_keep_every_film(spark, capsys):
    d = tempfile.mkdtemp(prefix="cinelens-jobs-raw-")
    g, c = "[{'id': 18, 'name': 'Drama'}]", "[{'name': 'Studio A', 'id': 1}]"
    rows = [movie(1, "1994-05-01", "100", "300", g, c), movie(1, "1994-05-01", "100", "300", g, c),
            movie(2, "1995-05-01", "0", "0", "[{'id'", c)]
    rows[1]["imdb_id"] = "other"
    for r in rows:
        r["original_title"] = "original " + r["title"]
    write(os.path.join(d, "movies.csv"), HEADER, rows)
    crew = "[{'department': 'Directing', 'job': 'Director', 'name': 'Ann'}]"
    write(os.path.join(d, "credits.csv"), ["cast", "crew", "id"],
          [{"cast": "[{'name': 'A'}]", "crew": crew, "id": i} for i in (1, 2)])
    write(os.path.join(d, "ratings.csv"), ["userid", "movieid", "ratings", "timestamp"],
          [{"userid": 1, "movieid": i, "ratings": 3.0 + i, "timestamp": 1} for i in (1, 2)])
    wh = os.path.join(d, "wh")
    run(spark, ["ingest-movies", "--csv", f"{d}/movies.csv", "--out", f"{wh}/movies"])
    assert "genres: 3 texts, 1 could not be read" in capsys.readouterr().out
    raw = read_keyed(spark, f"{wh}/movies")
    assert raw.count() == 3 and len(raw.columns) == 24
    run(spark, ["ingest-credits", "--csv", f"{d}/credits.csv", "--out", f"{wh}/credits"])
    run(spark, ["ingest-ratings", "--csv", f"{d}/ratings.csv", "--out", f"{wh}/ratings"])
    run(spark, ["average-ratings", "--catalog", f"{wh}/movies", "--ratings", f"{wh}/ratings",
                "--out", f"{wh}/avg"])
    # one row for the repeated id; the film without budget keeps its average
    assert sorted((r.movieid, r.average_rating) for r in spark.read.parquet(f"{wh}/avg").collect()) == [
        (1, 4.0), (2, 5.0)]
    run(spark, ["directors", "--catalog", f"{wh}/movies", "--credits", f"{wh}/credits", "--ratings",
                f"{wh}/ratings", "--out", f"{d}/out", "--n", "1", "--title", "original_title"])
    assert read_out(f"{d}/out") == [("1", "Ann", "original m1,original m2", "4.5")]
