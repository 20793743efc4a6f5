"""Readers: CSV with a declared schema, and parquet tables by name."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.dates import text_date
from ..functions.literals import items_schema, parse_pylist

#: Columns of checked rows beside the declared ones.
PROBLEMS, RAW, _CORRUPT = "_problems", "_raw", "_corrupt"


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True,
             multi_line: bool = True) -> DataFrame:
    """CSV with an explicit schema (never inferred: inference is an extra pass).

    ``multiLine`` keeps a quoted field with a newline in one row and
    ``escape='"'`` reads the doubled quotes the catalog files use inside
    quoted fields. A multi-line CSV file is read by one task per file, so
    large inputs should arrive as many files (or be converted to parquet once
    with ``write_keyed_table``).
    """
    return (spark.read.schema(schema)
            .option("header", header)
            .option("multiLine", multi_line)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return text_date(text)
    return F.trim(text).try_cast(kind)


def read_csv_checked(spark: SparkSession, path, schema: T.StructType, header: bool = True,
                     multi_line: bool = True) -> DataFrame:
    """CSV rows with the declared types, ``_problems`` (array of texts) and ``_raw`` (JSON of the fields).

    Fields are read as text and cast one by one, so a field that does not fit its type is told by
    name and value instead of becoming a silent NULL; a record with too many or too few fields is
    the problem ``record``. ``_raw`` is only filled where there are problems.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]).add(_CORRUPT, T.StringType())
    rows = (spark.read.schema(texts).option("header", header).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    values, problems = [], [F.when(F.col(_CORRUPT).isNotNull(), F.lit("record"))]
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        value = _typed(text, f.dataType)
        values.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            problems.append(F.when(value.isNull() & (F.trim(text) != ""), F.concat(F.lit(f"{f.name}: "), text)))
    found = F.array_compact(F.array(*problems))
    raw = F.when(F.size(found) > 0, F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))))
    return rows.select(*values, found.alias(PROBLEMS), raw.alias(RAW))


@dataclass
class Ingested:
    """What one pass over raw files leaves: good rows, rejected rows, and counts from that pass."""

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def ingest_csv(spark: SparkSession, path, schema: T.StructType, staging: str, lists=(), **kw) -> Ingested:
    """Read raw CSV once, write it as Parquet below ``staging``, split into good and rejected rows.

    The counts -- ``rows``, ``rejected``, ``bad_<column>`` per typed column, ``bad_record``, and per
    column of list text ``<column>_rows`` and ``<column>_failed`` (texts that cannot be read) -- are
    observed during that write; the raw file is not read again. Rejected rows keep ``_problems`` and
    ``_raw``. A multi-line file is read by one task; what follows reads the staged files in parallel.
    """
    rows = read_csv_checked(spark, path, schema, **kw)
    typed = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    seen = Observation(f"csv-{uuid.uuid4().hex}")
    has = lambda start: F.exists(PROBLEMS, lambda p: p.startswith(start))
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(PROBLEMS) > 0).alias("rejected"),
               F.count_if(F.array_contains(PROBLEMS, "record")).alias("bad_record")]
    metrics += [F.count_if(has(f"{c}: ")).alias(f"bad_{c}") for c in typed]
    for c in lists:
        good = F.col(c).isNotNull() & (F.size(PROBLEMS) == 0)
        metrics += [F.count_if(good).alias(f"{c}_rows"),
                    F.count_if(good & parse_pylist(c, items_schema("name")).isNull()).alias(f"{c}_failed")]
    marked = rows.observe(seen, *metrics).withColumn("_good", F.size(PROBLEMS) == 0)
    marked.write.partitionBy("_good").parquet(staging)
    kinds = T.StructType(marked.schema.fields[:-1]).add("_good", T.BooleanType())
    staged = spark.read.schema(kinds).parquet(staging)
    return Ingested(staged.where("_good").select(*[F.col(f"`{f.name}`") for f in schema.fields]),
                    staged.where("NOT _good").drop("_good"), dict(seen.get))


def read_catalog_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, schemas.MOVIES_CSV, **kw)


def read_credits_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, schemas.CREDITS_CSV, **kw)


def read_ratings_csv(spark: SparkSession, path, **kw) -> DataFrame:
    """Ratings are numeric fields only (no quoted newlines), so the file is read
    splittable -- many tasks per file -- unless ``multi_line=True`` is passed."""
    kw.setdefault("multi_line", False)
    return read_csv(spark, path, schemas.RATINGS_CSV, **kw)


def read_table(spark: SparkSession, base: str, name: str, view: str | None = None,
               schema=None) -> DataFrame:
    """Parquet table ``{base}/{name}.parquet`` (filters and column selections on
    the result are pushed into the scan). The schema is the given one, else the
    declared one for known tables (no inference job), else read from the files.
    Optionally registered as a temp view (create-or-replace, so a second call in
    one session does not fail)."""
    schema = schema or schemas.DRIVER_TABLES.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(f"{base.rstrip('/')}/{name}.parquet")
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_table_footers(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``read_table`` for whole-table counts and minima or maxima of stored columns.

    Read through Spark's newer Parquet source, which takes an aggregate without filter or group from
    the files' footers where ``spark.sql.parquet.aggregatePushdown`` is on (``get_session`` sets it):
    no page is read. Elsewhere it is an ordinary scan.
    """
    key = "spark.sql.sources.useV1SourceList"
    old = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in old.split(",") if x.strip() != "parquet"))
    try:
        return read_table(spark, base, name)
    finally:
        spark.conf.set(key, old)
