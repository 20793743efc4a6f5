"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame
over the driver tables seen as film data (see ``sources.fixtures``)."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import plans as P
from .plans import sql as S
from .operators.dedup import dedup_by_key as _dedup
from .operators.filters import null_audit as _null_audit
from .sources import fixtures as fx
from .session import checkpoint_dir
from .sources.keyed import read_keyed, write_keyed
from .sources.readers import ingest_csv, read_csv, read_table, read_table_footers
from .sources.writers import to_store_text, write_csv
from .functions.dates import decade_start, month_in, year_in
from .functions.literals import parse_names

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Columns of the cleaned catalog the driver tables can supply (no
# production_countries / vote_average there).
PROFIT_YEARS = (2000, 2019)

FIXTURE_CATALOG = ("budget", "genres", "id", "original_language", "popularity",
                   "production_companies", "release_date", "revenue", "runtime",
                   "title", "vote_count")


def _raw_catalog(spark, d):
    f = fx.films(spark, d, ["budget", "genres_text", "id", "original_language", "popularity",
                            "production_companies", "release_date", "revenue", "runtime",
                            "title", "vote_count"])
    return f.withColumnRenamed("genres_text", "genres")


def clean_catalog(spark: SparkSession, d: str) -> DataFrame:
    return to_store_text(P.clean_catalog(_raw_catalog(spark, d), columns=FIXTURE_CATALOG))


def catalog_parse_report(spark, d):
    f = fx.films(spark, d, ["genres_text", "production_companies"])
    return P.parse_report(f, ["genres_text", "production_companies"])


def parse_report_with_failures(spark, d):
    """The same report over genre texts of which some are cut short (every order whose number of
    lines is even loses the closing bracket): those must be counted, not read."""
    f = fx.films(spark, d, ["genres_text", "vote_count"])
    cut = F.expr("substr(genres_text, 1, length(genres_text) - 1)")
    return P.parse_report(f.select(F.when(F.col("vote_count") % 2 == 0, cut).otherwise(
        F.col("genres_text")).alias("genres_text")), ["genres_text"])


def text_date_parts(spark, d):
    """Year, month and calendar decade of release dates held as yyyy-mm-dd text, per film."""
    f = fx.films(spark, d, ["id", "release_date"]).withColumn("release_date", F.col("release_date").cast("string"))
    return f.select("id", year_in(f, "release_date").alias("year"), month_in(f, "release_date").alias("month"),
                    decade_start(year_in(f, "release_date")).alias("decade"))


def titles_by_popularity(spark, d):
    """Titles and runtimes of the films, ordered by a column that is not among those returned."""
    f = fx.films(spark, d, ["id", "title", "runtime", "popularity"])
    return f.orderBy(F.desc_nulls_last("popularity"), "id").select("title", "runtime")


def clean_credits(spark, d):
    return P.clean_credits(fx.credits(spark, d))


def dedup_by_key(spark, d):
    li = read_table(spark, d, "lineitem")
    return dedup_by_key_op(li)


def dedup_by_key_op(li: DataFrame) -> DataFrame:
    """Latest shipped line wins per (l_orderkey, l_linenumber)."""
    return _dedup(li, ["l_orderkey", "l_linenumber"], order=["l_shipdate"], keep="last")


def null_audit(spark, d):
    f = fx.films(spark, d, ["id", "title", "release_date", "budget", "revenue", "runtime",
                            "popularity", "vote_count"])
    return _null_audit(f)


def parse_names_exploded(spark, d):
    f = fx.films(spark, d, ["id", "production_companies"])
    return f.select("id", F.explode(parse_names("production_companies")).alias("company"))


def first_matching_member(spark, d):
    return P.directors_of(fx.credits(spark, d))


def avg_rating_per_film(spark, d):
    return P.avg_rating_per_film(fx.ratings(spark, d))


def avg_ratings_with_title_year(spark, d):
    return P.avg_ratings_with_title_year(fx.ratings(spark, d),
                                         fx.films(spark, d, ["id", "title", "release_date"]))


def top_rated_per_decade(spark, d):
    return P.top_rated_per_decade(avg_ratings_with_title_year(spark, d))


def genre_counts_by_decade(spark, d):
    return P.genre_counts_by_decade(fx.films(spark, d, ["id", "release_date", "genres"]))


def genre_counts_from_stored_catalog(spark, d):
    """The cleaned catalog as stored (genres as list text), read back by the
    genre count: the clean -> keyed table -> genre trend chain."""
    return P.genre_counts_by_decade(clean_catalog(spark, d))


def top_genre_per_decade(spark, d):
    return P.top_genre_per_decade(genre_counts_by_decade(spark, d))


def _money_films(spark, d, extra=(), years=None):
    return fx.films(spark, d, ["id", "title", "release_date", "budget", "revenue", *extra], years)


def company_profit_by_decade(spark, d):
    return P.company_profit_by_decade(_money_films(spark, d, ["production_companies"]))


def top_company_per_decade(spark, d):
    return P.top_company_per_decade(company_profit_by_decade(spark, d))


def profit_percentage(spark, d):
    return P.profit_percentage(_money_films(spark, d))


def avg_profit_by_year_month(spark, d):
    return P.avg_profit_by_year_month(_money_films(spark, d, years=PROFIT_YEARS))


def month_ranking(spark, d):
    return P.month_ranking(_money_films(spark, d, years=PROFIT_YEARS))


def votes_by_decade(spark, d):
    return P.votes_by_decade(fx.films(spark, d, ["release_date", "vote_count"]))


def releases_by_decade(spark, d):
    return P.releases_by_decade(fx.films(spark, d, ["title", "release_date"]))


def longest_per_language(spark, d):
    return P.longest_per_language(fx.films(spark, d, ["title", "original_language", "runtime",
                                                      "popularity"]))


def longest_document_per_language(spark, d):
    return P.longest_per_language(fx.documents(spark, d))


def year_span(spark, d):
    return P.year_span(fx.films(spark, d, ["release_date"]))


def _director_films(spark, d):
    return P.director_films(fx.films(spark, d, ["id", "title", "release_date"]),
                            fx.credits(spark, d), fx.ratings(spark, d))


def director_scores_by_window(spark, d):
    return P.director_scores_by_window(_director_films(spark, d), width=10)


def top_directors_per_window(spark, d):
    return P.top_directors_per_window(_director_films(spark, d), n=5, width=10)


def top_directors_per_2y_window(spark, d):
    return P.top_directors_per_window(_director_films(spark, d), n=5, width=2)


def filmography(spark, d):
    return P.filmography(_director_films(spark, d))


def _tag(d: str) -> str:
    """Part of a view name: one per folder, so two scales can be built at the same time."""
    return f"{zlib.crc32(d.encode()):08x}"


def _films_view(spark, d, cols, name):
    # one view per query: spark.sql resolves the view when called, so queries
    # built concurrently on one session never see each other's view
    return S.register_films(fx.films(spark, d, cols), f"cinelens_films_{name}_{_tag(d)}")


def avg_profit_by_year_month_sql(spark, d):
    view = _films_view(spark, d, ["id", "release_date", "budget", "revenue"], "profit")
    return S.avg_profit_by_year_month(spark, view)


def votes_by_decade_sql(spark, d):
    return S.votes_by_decade(spark, _films_view(spark, d, ["release_date", "vote_count"], "votes"))


def releases_by_decade_sql(spark, d):
    return S.releases_by_decade(spark, _films_view(spark, d, ["title", "release_date"], "releases"))


def longest_per_language_sql(spark, d):
    view = _films_view(spark, d, ["title", "original_language", "runtime", "popularity"], "longest")
    return S.longest_per_language(spark, view)


def filmography_rows(spark, d):
    return P.filmography_rows(_director_films(spark, d))


def avg_ratings_with_title_year_sql(spark, d):
    films = _films_view(spark, d, ["id", "title", "release_date"], "avg")
    ratings = S.register_films(fx.ratings(spark, d), f"cinelens_ratings_avg_{_tag(d)}")
    return S.avg_ratings_with_title_year(spark, ratings, films)


def _through_csv(spark, df: DataFrame, **kw) -> DataFrame:
    """The result as a CSV report in a fresh shared folder, read back with its declared schema.

    Unlike the other queries this one writes when it is built."""
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(df, path, header=True, **kw)
    return read_csv(spark, path, df.schema).select(*df.columns)


def genre_counts_csv(spark, d):
    return _through_csv(spark, genre_counts_by_decade(spark, d))


def votes_csv_single_file(spark, d):
    return _through_csv(spark, votes_by_decade(spark, d), single=True)


def directors_csv_by_window(spark, d):
    """One directory per window, its rows in rank order."""
    return _through_csv(spark, top_directors_per_2y_window(spark, d), partition_by="window", order_by="rank")


def row_counts(spark, d):
    return P.row_counts({t: read_table_footers(spark, d, t) for t in TABLES})


def _folder(spark, kind: str) -> str:
    return f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def filmography_chunks(spark, d):
    """Career titles in texts of 25; this one runs jobs when it is built (it fixes a range sort)."""
    return P.filmography_chunks(_director_films(spark, d), size=25)


#: Ship dates at which the batches of ``keyed_upsert`` begin.
UPSERT_ERAS = ("1994-01-01", "1996-01-01")


def keyed_upsert(spark, d):
    """The latest line per (part, supplier): a keyed table takes the lines in three batches by ship
    date, each an upsert, and is read back."""
    li = read_table(spark, d, "lineitem")
    day = F.col("l_shipdate")
    first, second = (F.lit(x).cast(li.schema["l_shipdate"].dataType) for x in UPSERT_ERAS)
    path = _folder(spark, "keyed")
    for batch in (day.isNull() | (day < first), (day >= first) & (day < second), day >= second):
        write_keyed(li.where(batch), path, ["l_partkey", "l_suppkey"], order=["l_shipdate"], keep="last",
                    mode="upsert", buckets=16)
    return read_keyed(spark, path).select(*li.columns)


RAW_FILM = T.StructType([
    T.StructField("budget", T.DoubleType()), T.StructField("genres", T.StringType()),
    T.StructField("id", T.LongType()), T.StructField("original_language", T.StringType()),
    T.StructField("popularity", T.DoubleType()), T.StructField("production_companies", T.StringType()),
    T.StructField("release_date", T.DateType()), T.StructField("revenue", T.DoubleType()),
    T.StructField("runtime", T.DoubleType()), T.StructField("title", T.StringType()),
    T.StructField("vote_count", T.LongType())])
RAW_COUNTS = ("rows", "rejected", "bad_record", "bad_id", "bad_release_date", "bad_runtime", "genres_rows",
              "genres_failed")


def _ingested(spark, d):
    """The films as a raw CSV file, read back through the checked ingest.

    Titles hold quotes and a line break; films whose number of votes is divisible by 5 have an
    impossible date, those divisible by 7 an id that is no number, those divisible by 3 a genre text
    that is cut short."""
    f = _raw_catalog(spark, d)
    votes = F.col("vote_count")
    cut = F.expr("substr(genres, 1, length(genres) - 1)")
    raw = f.select(
        "budget", F.when(votes % 3 == 0, cut).otherwise(F.col("genres")).alias("genres"),
        F.when(votes % 7 == 0, F.concat(F.lit("tt"), F.col("id"))).otherwise(F.col("id").cast("string")).alias("id"),
        "original_language", "popularity", "production_companies",
        F.when(votes % 5 == 0, F.lit("2001-13-45")).otherwise(F.col("release_date").cast("string")).alias("release_date"),
        "revenue", "runtime", F.concat(F.lit('The "'), F.col("title"), F.lit('",\na film')).alias("title"), "vote_count")
    path = _folder(spark, "raw")
    raw.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return ingest_csv(spark, path, RAW_FILM, _folder(spark, "ingest"), lists=["genres"])


def catalog_from_raw_csv(spark, d):
    """Raw CSV -> rows that fit their types -> cleaned catalog -> keyed table -> read back."""
    path = _folder(spark, "keyed")
    write_keyed(to_store_text(P.clean_catalog(_ingested(spark, d).good, columns=FIXTURE_CATALOG)), path, ["id"],
                assume_unique=True)
    return read_keyed(spark, path)


def raw_csv_rejects(spark, d):
    """The rejected rows of the same file, each with its problems."""
    got = _ingested(spark, d).rejected
    return got.select("id", "title", F.array_join("_problems", "; ").alias("problems"),
                      F.get_json_object("_raw", "$.id").alias("raw_id"))


def raw_csv_counts(spark, d):
    """What the one pass over that file has counted."""
    n = _ingested(spark, d).counts
    return spark.createDataFrame([tuple(n[c] for c in RAW_COUNTS)], ", ".join(f"{c} long" for c in RAW_COUNTS))


def _stored(spark, *frames):
    """Each frame as a table bucketed on film id, below the shared folder."""
    out = []
    for df in frames:
        tag = uuid.uuid4().hex
        out.append(P.store_bridge(df, f"{checkpoint_dir(spark)}/bridge-{tag}", f"cinelens_bridge_{tag}", 8,
                                  sort=[c for c in ("id", "position") if c in df.columns]))
    return out


def genre_counts_from_bridge(spark, d):
    f = fx.films(spark, d, ["id", "release_date", "genres_text"])
    films, genres = _stored(spark, f.select("id", "release_date"), P.names_bridge(f, "genres_text"))
    return P.genre_counts_from_bridge(films, genres)


def company_profit_from_bridge(spark, d):
    f = _money_films(spark, d, ["production_companies"])
    films, companies = _stored(spark, f.select("id", "release_date", "budget", "revenue"),
                               P.names_bridge(f, "production_companies"))
    return P.company_profit_from_bridge(films, companies)


def top_directors_from_bridge(spark, d):
    films, crew = _stored(spark, fx.films(spark, d, ["id", "title", "release_date"]),
                          P.crew_bridge(fx.credits(spark, d)))
    return P.top_directors_per_window(P.director_films(
        films, None, fx.ratings(spark, d), directors=P.directors_from_bridge(crew)), n=5, width=10)


#: Queries that write something when they are built (files they then read back, or a checkpoint).
WRITES = ("director_scores_by_window", "top_directors_per_window", "top_directors_per_2y_window", "genre_counts_csv", "votes_csv_single_file", "directors_csv_by_window", "filmography_chunks", "keyed_upsert",
          "catalog_from_raw_csv", "raw_csv_rejects", "raw_csv_counts", "genre_counts_from_bridge",
          "company_profit_from_bridge", "top_directors_from_bridge")


QUERIES = {
    "clean_catalog": clean_catalog,
    "clean_credits": clean_credits,
    "catalog_parse_report": catalog_parse_report,
    "parse_report_with_failures": parse_report_with_failures,
    "text_date_parts": text_date_parts,
    "titles_by_popularity": titles_by_popularity,
    "dedup_by_key": dedup_by_key,
    "null_audit": null_audit,
    "parse_names_exploded": parse_names_exploded,
    "first_matching_member": first_matching_member,
    "avg_rating_per_film": avg_rating_per_film,
    "avg_ratings_with_title_year": avg_ratings_with_title_year,
    "top_rated_per_decade": top_rated_per_decade,
    "genre_counts_by_decade": genre_counts_by_decade,
    "genre_counts_from_stored_catalog": genre_counts_from_stored_catalog,
    "top_genre_per_decade": top_genre_per_decade,
    "company_profit_by_decade": company_profit_by_decade,
    "top_company_per_decade": top_company_per_decade,
    "profit_percentage": profit_percentage,
    "avg_profit_by_year_month": avg_profit_by_year_month,
    "month_ranking": month_ranking,
    "votes_by_decade": votes_by_decade,
    "releases_by_decade": releases_by_decade,
    "longest_per_language": longest_per_language,
    "longest_document_per_language": longest_document_per_language,
    "year_span": year_span,
    "director_scores_by_window": director_scores_by_window,
    "top_directors_per_window": top_directors_per_window,
    "top_directors_per_2y_window": top_directors_per_2y_window,
    "filmography": filmography,
    "filmography_rows": filmography_rows,
    "row_counts": row_counts,
    "genre_counts_csv": genre_counts_csv,
    "votes_csv_single_file": votes_csv_single_file,
    "directors_csv_by_window": directors_csv_by_window,
    "avg_ratings_with_title_year_sql": avg_ratings_with_title_year_sql,
    "avg_profit_by_year_month_sql": avg_profit_by_year_month_sql,
    "votes_by_decade_sql": votes_by_decade_sql,
    "releases_by_decade_sql": releases_by_decade_sql,
    "longest_per_language_sql": longest_per_language_sql,
    "filmography_chunks": filmography_chunks,
    "keyed_upsert": keyed_upsert,
    "catalog_from_raw_csv": catalog_from_raw_csv,
    "raw_csv_rejects": raw_csv_rejects,
    "raw_csv_counts": raw_csv_counts,
    "genre_counts_from_bridge": genre_counts_from_bridge,
    "company_profit_from_bridge": company_profit_from_bridge,
    "top_directors_from_bridge": top_directors_from_bridge,
}
