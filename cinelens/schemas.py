"""Declared schemas of the film-catalog data model (one place for all of them)."""

from pyspark.sql import types as T

# Raw catalog CSV: 24 columns. ``runtime`` is declared double on read because
# the files carry values such as ``81.0``; reading those as int yields NULL and
# the cleaning step would then drop the film. It is cast to int after parsing.
MOVIES_CSV = T.StructType([
    T.StructField("adult", T.BooleanType()),
    T.StructField("belongs_to_collection", T.StringType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("genres", T.StringType()),
    T.StructField("homepage", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("production_companies", T.StringType()),
    T.StructField("production_countries", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("runtime", T.DoubleType()),
    T.StructField("spoken_languages", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("video", T.BooleanType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.IntegerType()),
])

# Credits CSV: crew and cast are list-of-dict literals held as text.
CREDITS_CSV = T.StructType([
    T.StructField("cast", T.StringType()),
    T.StructField("crew", T.StringType()),
    T.StructField("id", T.IntegerType()),
])

# Ratings file (grain: one row per user and film).
RATINGS_CSV = T.StructType([
    T.StructField("userid", T.IntegerType()),
    T.StructField("movieid", T.IntegerType()),
    T.StructField("ratings", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

# Columns kept by catalog cleaning, in output order (the cleaned keyed table).
CATALOG_COLUMNS = (
    "budget", "genres", "id", "original_language", "popularity",
    "production_companies", "production_countries", "release_date", "revenue",
    "runtime", "title", "vote_average", "vote_count",
)

# The raw movies table: every CSV column, keyed by (id, imdb_id).
RAW_MOVIE_COLUMNS = tuple(MOVIES_CSV.fieldNames())
RAW_MOVIE_KEYS = ("id", "imdb_id")

# Element schemas of the list-of-dict text columns, read by ``from_json``.
NAMED_ITEM = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
]))

CREW_ITEM = T.ArrayType(T.StructType([
    T.StructField("department", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("name", T.StringType()),
]))

# Average-rating table written by the ratings step and read by the decade ranking.
AVG_RATINGS = T.StructType([
    T.StructField("movieid", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("year_of_release", T.IntegerType()),
    T.StructField("average_rating", T.DoubleType()),
])

# Generated test tables (see TESTDATA.md), declared so that reads skip the
# schema-inference job (a footer-reading Spark job per read without one).
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
