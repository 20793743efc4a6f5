"""Helpers shared by the operators: table reading, checkpoints, Arrow columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.session import checkpoint_dir

#: White space as the contracts define it: space and \x09-\x0D. ``bytes.split()``
#: splits on exactly these six bytes.
BLANKS = " \t\n\x0b\x0c\r"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_find_us(spark: SparkSession) -> None:
    """Let Python workers import this package also when the entry file was loaded by path.

    On a cluster the package is shipped with ``--py-files``; there the added
    path does not exist and is ignored.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, _ROOT])


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | T.StructType, rows: int | None = 1024) -> DataFrame:
    """``df.mapInArrow``, with the package importable in the workers.

    ``fn`` sees at most ``rows`` rows at a time, so that Python holds the texts of that many rows
    and not of a whole Arrow batch as objects.
    """
    workers_find_us(df.sparkSession)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = rows or max(1, batch.num_rows)
            for at in range(0, max(1, batch.num_rows), step):
                yield batch.slice(at, step)

    return df.mapInArrow(lambda batches: fn(parts(batches)), schema)


def row_schema(ddl: str, **more: T.DataType) -> T.StructType:
    """Schema from DDL text plus fields whose types (with any column names) are given."""
    schema = T.StructType.fromDDL(ddl) if ddl else T.StructType()
    for name, kind in more.items():
        schema = schema.add(name, kind)
    return schema


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder below the shared checkpoint folder (each call a new one)."""
    base = spark.sparkContext.getCheckpointDir() or checkpoint_dir(spark)
    return f"{base}/{kind}-{uuid.uuid4().hex}"


def blobs(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif not pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    return [b or b"" for b in column.to_pylist()]


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)],
        schema=schema)


#: Keys up to this many are joined by broadcast; more as Spark sees fit.
FEW_KEYS = 100_000


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row per ``keys`` (never null) and the number of its ``copies``.

    Rows that occur once stay where they are. Of repeated ones a map-side-combined aggregate keeps
    one, so a row that makes up a third of a table never meets itself in one task. Rows equal in
    ``keys`` must be equal in the other columns.
    """
    if {"copies", "copies_n", "rest"} & set(df.columns):
        raise ValueError("copies, copies_n and rest are names of the result's own columns")
    repeated = checkpointed(df.groupBy(*keys).agg(F.count("*").alias("copies_n")).where("copies_n > 1"))
    n = repeated.count()
    if not n:
        return df.withColumn("copies", F.lit(1).cast("long"))
    named = repeated.select(*[F.col(k).alias(f"copies_{i}") for i, k in enumerate(keys)], "copies_n")
    side = F.broadcast(named) if n <= FEW_KEYS else named
    same = [F.col(k) == F.col(f"copies_{i}") for i, k in enumerate(keys)]
    single = df.join(side, same, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    rest = [c for c in df.columns if c not in keys]
    several = df.join(side, same).groupBy(*keys).agg(
        F.first(F.struct(*rest)).alias("rest"), F.first("copies_n").alias("copies"))
    return single.unionByName(several.select(*keys, *[F.col("rest").getField(c).alias(c) for c in rest], "copies"))


def bounded_sample(rows: DataFrame, key: Column, most: int, seed: int = 11) -> DataFrame:
    """At most about ``most`` rows of ``rows``, one per ``key`` (rows equal in it count once), by a hash of it.

    Copies are combined in the map tasks, so a key on a third of all rows does not meet in one.
    """
    own = rows.columns
    one = rows.withColumn("sample_key", key).groupBy("sample_key").agg(F.first(F.struct(*own)).alias("r"))
    fixed = checkpointed(one)
    n = fixed.count()
    if n > most:
        fixed = fixed.where(F.pmod(F.xxhash64(F.lit(seed), "sample_key"), F.lit(1 << 20)) < int((1 << 20) * most / n))
    return fixed.select([F.col("r").getField(c).alias(c) for c in own])


def _running(ends: dict[int, int], value: int):
    """Append the sum of column ``value`` over all rows before, within a sorted partition and by ``ends`` before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if done is None:
                done = ends[batch.column(0)[0].as_py()]
            own = batch.column(value).to_numpy(zero_copy_only=False)
            sums = np.cumsum(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(done + sums - own, pa.int64())],
                                             names=[*batch.schema.names[1:], "prefix"])
            done += int(sums[-1])

    return run


def prefix_sums(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of the long column ``value`` (never null) over all rows before, by ``order``.

    Range partitions, fixed by a checkpoint; one sum per partition is all the driver sees. ``df`` is
    read twice (bounds, then rows), so a dear one should be checkpointed first. Rows equal in
    ``order`` follow one another in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = checkpointed(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .select(F.spark_partition_id().alias("prefix_part"), "*"))
    sums = fixed.groupBy("prefix_part").agg(F.sum(value).alias("v")).collect()
    ends, done = {}, 0
    for part, v in sorted(tuple(r) for r in sums):
        ends[part] = done
        done += v
    schema = T.StructType(fixed.schema.fields[1:]).add("prefix", T.LongType())
    return arrow_map(fixed, _running(ends, fixed.columns.index(value)), schema, rows=None).withColumnRenamed("prefix", name)
