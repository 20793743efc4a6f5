"""Command-line jobs: load the raw files into keyed tables, answer each
question from the tables, write CSV results.

    python -m cinelens.jobs ingest-catalog --csv movies_metadata.csv --out wh/movies_etl
    python -m cinelens.jobs ingest-credits --csv credits.csv --out wh/credits
    python -m cinelens.jobs ingest-ratings --csv ratings.csv --out wh/ratings
    python -m cinelens.jobs average-ratings --catalog wh/movies_etl --ratings wh/ratings --out wh/avg_ratings
    python -m cinelens.jobs top-rated --avg-ratings wh/avg_ratings --out out/top_rated
    python -m cinelens.jobs directors --catalog wh/movies_etl --credits wh/credits \\
        --ratings wh/ratings --out out/directors --n 5 --width 10
    ... genres | top-genres | companies | profit-month | profit-months-ranked |
        votes-trend | movies-trend | longest-running  (--catalog, --out)
    python -m cinelens.jobs ingest-movies --csv movies_metadata.csv --out wh/movies   # all 24 columns

Ingest jobs read the raw file once -- rows whose fields do not fit the declared types go to
``<out>.rejected`` with the reason -- and then write the keyed table from the staged rows; all other
jobs are one Spark action. Tables are parquet paths or catalog tables
(``--table`` / ``--buckets`` on the ingest and average jobs store a table
bucketed on its key, for shuffle-free joins on film id; later jobs accept the
table name in place of a path). Results are CSV (small aggregated results as a
single file, the directors as one directory per window).
"""

from __future__ import annotations

import argparse
import sys
import uuid

from . import plans as P
from .operators import dedup_by_key
from .schemas import CREDITS_CSV, MOVIES_CSV, RATINGS_CSV, RAW_MOVIE_KEYS
from .session import checkpoint_dir, get_session
from .sources import ingest_csv, is_keyed_table, read_keyed, write_csv, write_keyed_table


def _load(spark, ref: str):
    """A catalog table by name, else a keyed table or plain parquet at a path."""
    if "/" not in ref and spark.catalog.tableExists(ref):
        return spark.table(ref)
    if is_keyed_table(spark, ref):
        return read_keyed(spark, ref)
    return spark.read.parquet(ref)


def _keyed(df, a, keys, **kw):
    write_keyed_table(df, a.out, keys, table=a.table, buckets=a.buckets, mode=a.mode, **kw)


def _catalog_report(fn, single=True):
    def run(spark, a):
        write_csv(fn(_load(spark, a.catalog)), a.out, single=single, header=a.header)
    return run


def _ingest(spark, a, schema, lists=(), multi_line=True):
    """Good rows of the raw file; rejected ones go to ``<out>.rejected``, and what was read is told."""
    got = ingest_csv(spark, a.csv, schema, f"{checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}", lists,
                     multi_line=multi_line)
    n = got.counts
    print(f"{n['rows']} rows read, {n['rejected']} rejected"
          + "".join(f", {c}: {k}" for c, k in n.items() if c.startswith("bad_") and k))
    for c in lists:
        print(f"{c}: {n[c + '_rows']} texts, {n[c + '_failed']} could not be read")
    if n["rejected"]:
        got.rejected.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}.rejected")
    return got.good


def _ingest_catalog(spark, a):
    raw = _ingest(spark, a, MOVIES_CSV, ["genres", "production_companies"], not a.single_line)
    _keyed(P.clean_catalog(raw), a, ["id"])


def _ingest_movies(spark, a):
    raw = _ingest(spark, a, MOVIES_CSV, ["genres", "production_companies"], not a.single_line)
    _keyed(P.raw_movies(raw), a, list(RAW_MOVIE_KEYS), assume_unique=True)


def _ingest_credits(spark, a):
    _keyed(P.clean_credits(_ingest(spark, a, CREDITS_CSV, ["cast", "crew"], not a.single_line)), a, ["id"])


def _ingest_ratings(spark, a):
    # grain is (user, film): one rating per user and film, the latest one wins; numeric fields only,
    # so the file is read by many tasks
    _keyed(_ingest(spark, a, RATINGS_CSV, multi_line=False), a, ["userid", "movieid"],
           order=["timestamp"], keep="last")


def _average_ratings(spark, a):
    # raw films may repeat an id (their key is id and imdb_id): one row per id first
    avg = P.avg_ratings_with_title_year(_load(spark, a.ratings), _load(spark, a.catalog),
                                        films_keyed=False)
    _keyed(avg, a, ["movieid"], assume_unique=True)


def _top_rated(spark, a):
    write_csv(P.top_rated_per_decade(_load(spark, a.avg_ratings)), a.out, header=a.header)


def _directors(spark, a):
    credits = P.directors_of(_load(spark, a.credits), job=a.job)
    films = dedup_by_key(_load(spark, a.catalog).select("id", a.title, "release_date"), ["id"])
    df = P.director_films(films, None, _load(spark, a.ratings), title=a.title, directors=credits)
    anchor = a.anchor if a.anchor in ("min", "calendar") else int(a.anchor)
    top = P.top_directors_per_window(df, n=a.n, width=a.width, anchor=anchor)
    write_csv(top, a.out, partition_by="window", header=a.header, order_by="rank")


JOBS = {
    "ingest-catalog": (_ingest_catalog, ["csv"]),
    "ingest-movies": (_ingest_movies, ["csv"]),
    "ingest-credits": (_ingest_credits, ["csv"]),
    "ingest-ratings": (_ingest_ratings, ["csv"]),
    "average-ratings": (_average_ratings, ["catalog", "ratings"]),
    "top-rated": (_top_rated, ["avg_ratings"]),
    "directors": (_directors, ["catalog", "credits", "ratings"]),
    "genres": (_catalog_report(P.genre_counts_by_decade, single=False), ["catalog"]),
    "top-genres": (_catalog_report(lambda f: P.top_genre_per_decade(P.genre_counts_by_decade(f))
                                   .orderBy("decade", "genre")), ["catalog"]),
    "companies": (_catalog_report(lambda f: P.top_company_per_decade(P.company_profit_by_decade(f))),
                  ["catalog"]),
    "profit-month": (_catalog_report(P.avg_profit_by_year_month), ["catalog"]),
    "profit-months-ranked": (_catalog_report(P.month_ranking), ["catalog"]),
    "votes-trend": (_catalog_report(P.votes_by_decade), ["catalog"]),
    "movies-trend": (_catalog_report(P.releases_by_decade), ["catalog"]),
    "longest-running": (_catalog_report(P.longest_per_language), ["catalog"]),
}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="cinelens.jobs")
    sub = ap.add_subparsers(dest="command", required=True)
    for name, (_, inputs) in JOBS.items():
        p = sub.add_parser(name)
        for i in inputs:
            p.add_argument("--" + i.replace("_", "-"), dest=i, required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--header", action="store_true")
        if name.startswith("ingest-") or name == "average-ratings":
            p.add_argument("--mode", choices=("error", "upsert", "overwrite"), default="error",
                           help="what to do with a table that is already there")
            p.add_argument("--table", default=None, help="also register as this catalog table")
            p.add_argument("--buckets", type=int, default=None,
                           help="bucket the table on its key (needs --table)")
        if name in ("ingest-catalog", "ingest-movies", "ingest-credits"):
            p.add_argument("--single-line", action="store_true",
                           help="no field holds a line break: large files are read by many tasks")
        if name == "directors":
            p.add_argument("--n", type=int, default=5)
            p.add_argument("--width", type=int, default=10)
            p.add_argument("--title", default="title")
            p.add_argument("--anchor", default="min", help="min | calendar | a year")
            p.add_argument("--job", default=None, help="also require this crew job")
    return ap


def run(spark, argv) -> None:
    a = parser().parse_args(argv)
    JOBS[a.command][0](spark, a)


def main(argv=None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    parser().parse_args(argv)  # --help and usage errors before any session starts
    run(get_session(app=f"cinelens-{argv[0]}"), argv)


if __name__ == "__main__":
    main()
