"""Driver tables seen as film data.

The generated test tables are an order/line-item star schema. This adapter
exposes them in the film-catalog data model so every operator runs on them
unchanged (and on data that grows with the tables):

films (one row per order)
    id = o_orderkey, title = ``Order#<key>``, release_date = o_orderdate,
    budget = o_totalprice, original_language = o_orderpriority;
    per order's lines: revenue = sum(price x (1 - discount)) (NULL without
    lines), runtime = max(quantity), popularity = sum(quantity),
    vote_count = number of lines, genres = distinct part types,
    companies = distinct supplier names; ``genres_text`` and
    ``production_companies`` are the same lists as Python-literal text.
ratings (one row per line)
    movieid = l_orderkey, ratings = l_quantity / 10, userid = o_custkey.
credits (one row per order with lines)
    crew = the lines ordered by (l_linenumber, s_name, flags) as
    ``{'department', 'job', 'name'}`` literals -- Directing/Director when
    l_returnflag = 'R', else Crew/None; cast = the lines with
    l_linestatus = 'O' as ``{'cast_id', 'name'}`` literals (``[]`` if none).

Per-film lists (genres, companies, crew) hold one entry per line of the
order -- the data model keeps a film's list in one value; orders here have
about four lines on average and at most 17 (sf0.1).

Only the sources a request needs are joined: each derived column names the
tables it comes from, so asking for ``id, release_date`` reads ``orders``
alone. Per-order aggregates are computed on ``lineitem`` (map-side combined)
before the join to ``orders``, which then reuses their hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import read_table

ORDER_COLUMNS = ("id", "title", "release_date", "budget", "original_language")
LINE_COLUMNS = ("revenue", "runtime", "popularity", "vote_count")
GENRE_COLUMNS = ("genres", "genres_text")
COMPANY_COLUMNS = ("companies", "production_companies")
FILM_COLUMNS = ORDER_COLUMNS + LINE_COLUMNS + GENRE_COLUMNS + COMPANY_COLUMNS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _pylist(items, render) -> "F.Column":
    """Render an array as a Python list literal ``[a, b]`` (NULL stays NULL)."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, render), ", "), F.lit("]"))


def films(spark: SparkSession, sf_dir: str, columns=FILM_COLUMNS, years=None) -> DataFrame:
    """One row per order, with the requested film columns (see module doc);
    only the tables those columns come from are read and joined.

    Numbers and lists are built in branches of their own: the numbers are
    aggregated without meeting a dimension table, and the lists carry only keys
    through their joins. ``years`` (start, end) keeps orders of start <= year <
    end; their lines are then picked by a semi-join before any aggregate.
    """
    cols = list(columns)
    unknown = set(cols) - set(FILM_COLUMNS)
    if unknown:
        raise ValueError(f"unknown film columns: {sorted(unknown)}")
    o = _read(spark, sf_dir, "orders")
    if years:
        start, end = (F.lit(f"{int(y):04d}-01-01").cast("timestamp_ntz") for y in years)
        o = o.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
    base = o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderdate").cast("date").alias("release_date"),
        F.col("o_totalprice").alias("budget"),
        F.col("o_orderpriority").alias("original_language"),
    )
    need_lines = any(c in cols for c in LINE_COLUMNS)
    need_genres = any(c in cols for c in GENRE_COLUMNS)
    need_comp = any(c in cols for c in COMPANY_COLUMNS)

    def lines(*names):
        li = _read(spark, sf_dir, "lineitem").select("l_orderkey", *names)
        return li.join(base.select(F.col("id").alias("l_orderkey")), "l_orderkey", "left_semi") if years else li

    df = base
    if need_lines:
        line_rev = (F.col("l_extendedprice").cast("decimal(12,2)")
                    * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
        numbers = lines("l_quantity", "l_extendedprice", "l_discount").groupBy("l_orderkey").agg(
            F.sum(line_rev).cast("double").alias("revenue"),
            F.max("l_quantity").cast("int").alias("runtime"),
            F.sum("l_quantity").alias("popularity"),
            F.count(F.lit(1)).alias("vote_count"))
        df = df.join(numbers.withColumnRenamed("l_orderkey", "_n"), F.col("id") == F.col("_n"), "left")
    if need_genres or need_comp:
        keys = lines(*(["l_partkey"] * need_genres + ["l_suppkey"] * need_comp))
        aggs = []
        if need_genres:
            part = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
            keys = keys.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").drop("l_partkey")
            aggs.append(F.array_sort(F.collect_set("p_type")).alias("_genres"))
        if need_comp:
            sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
            keys = keys.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            aggs.append(F.array_sort(F.collect_set(F.when(
                F.col("s_name").isNotNull(), F.struct("s_name", "s_suppkey")))).alias("_comp"))
        lists = keys.groupBy(F.col("l_orderkey").alias("_l")).agg(*aggs)
        df = df.join(lists, F.col("id") == F.col("_l"), "left")

    derived = {}
    if need_genres:
        derived["genres"] = F.col("_genres")
        derived["genres_text"] = _pylist(
            F.col("_genres"),
            lambda x, i: F.concat(F.lit("{'id': "), (i + 1).cast("string"),
                                  F.lit(", 'name': '"), x, F.lit("'}")))
    if need_comp:
        derived["companies"] = F.transform("_comp", lambda x: x["s_name"])
        derived["production_companies"] = _pylist(
            F.col("_comp"),
            lambda x: F.concat(F.lit("{'name': '"), x["s_name"], F.lit("', 'id': "),
                               x["s_suppkey"].cast("string"), F.lit("}")))
    return df.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in cols])


def ratings(spark: SparkSession, sf_dir: str, with_user: bool = False) -> DataFrame:
    """(movieid, ratings[, userid]); the user join is only made when asked for."""
    li = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("movieid"),
        (F.col("l_quantity") / F.lit(10.0)).alias("ratings"))
    if not with_user:
        return li
    o = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movieid"), F.col("o_custkey").alias("userid"))
    return li.join(o, "movieid").select("userid", "movieid", "ratings")


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cast, crew) with crew/cast as Python-literal text (see module doc)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    li = li.join(sup, li.l_suppkey == sup.s_suppkey, "left")
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.struct("l_linenumber", "s_name", "l_returnflag", "l_linestatus"))).alias("_lines"))

    def crew_item(x):
        head = F.when(x["l_returnflag"] == "R",
                      F.lit("{'department': 'Directing', 'job': 'Director', 'name': '")
                      ).otherwise(F.lit("{'department': 'Crew', 'job': None, 'name': '"))
        return F.concat(head, F.coalesce(x["s_name"], F.lit("null")), F.lit("'}"))

    cast_lines = F.filter("_lines", lambda x: x["l_linestatus"] == "O")
    return per.select(
        F.col("l_orderkey").alias("id"),
        _pylist(cast_lines, lambda x: F.concat(
            F.lit("{'cast_id': "), x["l_linenumber"].cast("string"), F.lit(", 'name': '"),
            F.coalesce(x["s_name"], F.lit("null")), F.lit("'}"))).alias("cast"),
        _pylist(F.col("_lines"), crew_item).alias("crew"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as (title, language, runtime, popularity) for the per-language
    longest report: title = doc_id as text, runtime = popularity = n_chars."""
    d = _read(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("title"),
                    F.col("lang").alias("original_language"),
                    F.col("n_chars").alias("runtime"),
                    F.col("n_chars").cast("double").alias("popularity"))
