"""Writers: CSV result files and keyed (upsert-by-key) parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_by_key
from .keyed import write_keyed


def to_store_text(df: DataFrame) -> DataFrame:
    """Render array/struct columns as JSON text, the form a text column of the
    keyed store holds (and the form CSV can carry)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, single: bool = False, partition_by=None,
              header: bool = False, mode: str = "overwrite", order_by=()) -> None:
    """Write result rows as CSV.

    ``single=True`` writes one part file with ``coalesce(1)``, which keeps the
    row order of a sorted result. Use it on sorted, aggregated results: the
    sort's exchange bounds what the single task does to reading the (small)
    sorted rows; without a sort before it, coalesce would pull the upstream
    stage -- e.g. the final merge of every map task's partial aggregates --
    into that one task as well.
    ``partition_by`` writes one sub-directory per value in a single job (e.g.
    one directory per time window) instead of one job per value.
    ``order_by`` sorts the rows of each sub-directory: range partitions on (directory, order), each
    sorted, so a large directory is spread over tasks and its files, taken by name, hold its rows
    in order; small directories are one file each unless a range ends inside one.
    """
    out = to_store_text(df)
    if partition_by and order_by:
        order = [F.col(c) if isinstance(c, str) else c for c in (
            *([partition_by] if isinstance(partition_by, str) else partition_by),
            *([order_by] if isinstance(order_by, str) else order_by))]
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    if single:
        out = out.coalesce(1)
    w = out.write.mode(mode).option("header", header)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)


def write_keyed_table(df: DataFrame, path: str, keys, order=(), keep: str = "first",
                      partition_by=None, assume_unique: bool = False,
                      table: str | None = None, buckets: int | None = None,
                      mode: str = "error") -> None:
    """Keyed-table write: one row per key (see ``dedup_by_key``).

    ``mode`` says what happens to a table that is already there: ``error``
    (default) refuses, ``upsert`` keeps its rows and replaces those whose key
    comes again, ``overwrite`` replaces the whole table.

    A table at a path is laid out in buckets of its keys (``sources.keyed``): an upsert
    reads and writes the touched buckets only, and a crash at any point loses nothing.
    ``buckets`` is their number.

    ``assume_unique=True`` skips the de-duplication for inputs unique on the
    key by construction (e.g. the output of a ``groupBy`` on it).

    ``table`` + ``buckets`` store it as a catalog table bucketed (and sorted)
    on the key: tables bucketed the same way on film id then join without any
    shuffle. The unique rows are hash-partitioned into ``buckets`` tasks
    first, so each bucket is one file; the de-duplication before it stays
    map-side combined, so a hot key never reaches that step in bulk. These, and tables
    with ``partition_by``, are merged whole: the merged rows are written beside the
    table, then the folders are swapped by rename; a swap that was cut off is finished
    by the next write.
    """
    if mode not in ("error", "overwrite", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    if not table and not partition_by:
        write_keyed(df, path, keys, order, keep, assume_unique, mode, buckets)
        return
    if buckets and not table:
        raise ValueError("a bucketed table needs a name: bucket specs live in the catalog")
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df if assume_unique else dedup_by_key(df, keys, order, keep)
    _finish_swap(spark, path)
    there = _exists(spark, path)
    if there and mode == "error":
        raise FileExistsError(f"{path} is already there: write with mode 'upsert' or 'overwrite'")
    if there and mode == "upsert":
        old = spark.read.parquet(path).withColumn("_new", F.lit(False))
        both = old.unionByName(out.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        merged = dedup_by_key(both, keys, order=["_new"], keep="last").drop("_new")
        beside = f"{path.rstrip('/')}.merge"
        _save(merged, beside, keys, partition_by, f"{table}__merge" if table else None, buckets, "overwrite")
        _swap(spark, beside, path)
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}__merge")
            spark.catalog.refreshTable(table)
        return
    _save(out, path, keys, partition_by, table, buckets, "error" if mode == "error" else "overwrite")


def _save(out: DataFrame, path: str, keys, partition_by, table, buckets, mode: str) -> None:
    if buckets:
        out = out.repartition(buckets, *keys)
    w = out.write.mode(mode)
    if buckets:
        w = w.bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if table:
        w.option("path", path).format("parquet").saveAsTable(table)
    else:
        w.parquet(path)


def _hadoop(spark, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def _swap(spark, new: str, path: str) -> None:
    """Put folder ``new`` in the place of ``path``; the old one goes last."""
    fs, target = _hadoop(spark, path)
    aside = _hadoop(spark, f"{path.rstrip('/')}.old")[1]
    if not fs.rename(target, aside) or not fs.rename(_hadoop(spark, new)[1], target):
        raise OSError(f"could not put {new} in the place of {path}")
    fs.delete(aside, True)


def _finish_swap(spark, path: str) -> None:
    """After a crash: if the table was moved away, the merged one takes its place; then the old one goes.

    The table is moved away only once the merged one is written whole."""
    fs, target = _hadoop(spark, path)
    aside, merged = (_hadoop(spark, f"{path.rstrip('/')}{x}")[1] for x in (".old", ".merge"))
    if fs.exists(aside):
        if not fs.exists(target) and not fs.rename(merged, target):
            raise OSError(f"could not put {merged} in the place of {path}")
        fs.delete(aside, True)
