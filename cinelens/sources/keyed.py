"""Keyed tables on files: one row per key, upserts that touch only the buckets of their keys.

Layout of a table at ``path``::

    path/_keyed.json              keys, number of buckets, schema
    path/key_bucket=17/part-*     the rows whose keys hash to bucket 17 (pmod(hash(keys), buckets))

Any Parquet reader can read it (``key_bucket`` is an ordinary partition column).

A write has three steps:

1. The new content of every bucket it touches -- the old rows of that bucket merged with the batch --
   is written to ``path.staged`` by a Spark job. Other buckets are neither read nor written.
2. ``path.staged/_commit.json`` is put in place by one rename. From here on the write counts.
3. Each staged bucket takes the place of the old one, then the commit note and the staging folder go.

Whoever comes next (reader or writer) first finishes what is pending: with a commit note step 3 is
done again, without one the staging folder is dropped. Both can be repeated at any point, so a
crash between any two steps loses nothing, and running the write again gives the same table. One
writer at a time; a reader that runs during step 3 may find a bucket between its two states.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_by_key

#: Buckets of a new table; some thousands suit large ones (a bucket is rewritten whole).
BUCKETS = 64
BUCKET = "key_bucket"
_ABOUT, _COMMIT = "_keyed.json", "_commit.json"


class _Files:
    """The few file operations needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}{name}")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {self.root}{old} to {self.root}{new}")

    def make(self, name: str) -> None:
        self.fs.mkdirs(self._path(name))

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(name))]

    def read(self, name: str) -> dict:
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """Put a small file in place whole: written beside, then renamed."""
        beside = f"{name}.writing"
        stream = self.fs.create(self._path(beside), True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        self.delete(name)
        self.move(beside, name)


def _nothing(_: str) -> None:
    pass


def is_keyed_table(spark: SparkSession, path: str) -> bool:
    """Whether a keyed table is at ``path`` (or becomes one when its pending write is finished)."""
    files = _Files(spark, path)
    return files.exists(f"/{_ABOUT}") or files.exists(f".staged/{_COMMIT}")


def finish_pending(spark: SparkSession, path: str, step: Callable[[str], None] = _nothing) -> None:
    """Finish or drop what a write that was cut off has left. ``step`` is called between the steps."""
    files = _Files(spark, path)
    if not files.exists(".staged"):
        return
    if not files.exists(f".staged/{_COMMIT}"):
        files.delete(".staged")
        return
    note = files.read(f".staged/{_COMMIT}")
    files.make("")
    if note["replace"]:  # whatever the new table does not have
        for name in sorted(set(files.names("")) - {_ABOUT, *note["buckets"]}):
            files.delete(f"/{name}")
            step(f"dropped {name}")
    for name in note["buckets"]:
        if files.exists(f".staged/{name}"):  # else it has been moved before
            files.delete(f"/{name}")
            step(f"removed {name}")
            files.move(f".staged/{name}", f"/{name}")
            step(f"moved {name}")
    files.write(f"/{_ABOUT}", note["about"])
    step("described")
    files.delete(f".staged/{_COMMIT}")
    step("uncommitted")
    files.delete(".staged")


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _about(spark: SparkSession, path: str) -> dict:
    return _Files(spark, path).read(f"/{_ABOUT}")


def _stored(spark: SparkSession, path: str, about: dict) -> DataFrame:
    """The stored rows with their bucket; columns added later read as NULL in older buckets."""
    schema = T.StructType.fromJson(about["schema"]).add(BUCKET, T.IntegerType())
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a keyed table."""
    finish_pending(spark, path)
    return _stored(spark, path, _about(spark, path)).drop(BUCKET)


def _merged(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the batch's row where both have one."""
    both = old.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    return dedup_by_key(both, keys, order=["_new"], keep="last").drop("_new")


def write_keyed(df: DataFrame, path: str, keys, order=(), keep: str = "first", assume_unique: bool = False,
                mode: str = "error", buckets: int | None = None, files_per_bucket: int = 1,
                step: Callable[[str], None] = _nothing) -> None:
    """Write ``df`` to the keyed table at ``path``: one row per key (see ``dedup_by_key``).

    ``mode``: ``error`` refuses a table that is there, ``overwrite`` replaces it, ``upsert`` keeps its
    rows and replaces those whose key comes again (a column that the batch lacks becomes NULL in
    them; a new column is NULL in the rows that stay). ``buckets`` is fixed when the table is made;
    ``files_per_bucket`` spreads a large bucket over tasks.
    """
    spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET} is the name of the table's own partition column")
    finish_pending(spark, path)
    files = _Files(spark, path)
    there = files.exists("")
    if there and mode == "error":
        raise FileExistsError(f"{path} is already there: write with mode 'upsert' or 'overwrite'")
    merge = there and mode == "upsert"
    batch = df if assume_unique else dedup_by_key(df, keys, order, keep)
    if merge and not files.exists(f"/{_ABOUT}"):  # plain Parquet files: they become a keyed table
        batch, merge = _merged(spark.read.parquet(path), batch, keys), False
    if merge:
        about = _about(spark, path)
        if about["keys"] != keys:
            raise ValueError(f"the table's keys are {about['keys']}, not {keys}")
        stored = T.StructType.fromJson(about["schema"])
        # as the table has them: equal keys of another type would fall into another bucket
        batch = batch.select(*[F.col(c).cast(stored[c].dataType).alias(c) if c in stored.names else F.col(c)
                               for c in batch.columns])
        fields = stored.fields + [f for f in batch.schema.fields if f.name not in stored.names]
        about["schema"] = json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json())
        batch = batch.withColumn(BUCKET, _bucket(keys, about["buckets"]))
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        if not touched:
            return
        out = _merged(_stored(spark, path, about).where(F.col(BUCKET).isin(touched)), batch, [BUCKET, *keys])
    else:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema.fields])
        about = {"keys": keys, "buckets": int(buckets or BUCKETS), "schema": json.loads(schema.json())}
        out = batch.withColumn(BUCKET, _bucket(keys, about["buckets"]))
    part = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(files_per_bucket))
    out.repartition(F.col(BUCKET), part).write.partitionBy(BUCKET).parquet(f"{path.rstrip('/')}.staged")
    step("staged")
    staged = [n for n in files.names(".staged") if n.startswith(f"{BUCKET}=")]
    files.write(f".staged/{_COMMIT}", {"about": about, "buckets": sorted(staged), "replace": not merge})
    step("committed")
    finish_pending(spark, path, step)
