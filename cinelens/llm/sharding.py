"""Operator 3: sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets by a seeded hash; the
number of buckets is chosen so that a bucket fits in a task's memory. Pass two
takes one bucket at a time, puts it in a canonical order, shuffles it with
Fisher-Yates (seeded by seed and bucket) and writes it to the shared folder.
The written buckets, read one after another, are a uniformly random order of
all records; cut into equal runs they are the shards.

The law is ``rows``: shard sizes differ by one record at most. Bucket counts
are read back from the written files, so the cut is exact; their running sum stays on Spark.

The seeded hash takes all columns of a record and, of rows equal in every column, a number: such
rows are counted first and numbered in chunks that are dealt out over the tasks, so they scatter
like others. A bucket's place depends on nothing else: the shards are the same whatever the
partitions of the input, and a task that is run again sends its records to the same buckets.
A task holds one bucket at a time and takes several one after another where there are more buckets
than shuffle partitions. (All columns must be hashable: no maps.)

Cases: a null text has no bytes; null ids and repeated rows are records like
any other; an empty table gives an empty result; all input columns are kept in
one struct, so their names cannot clash with those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, checkpointed, one_of_each, prefix_sums, row_schema, shared_folder

SHARDS, SEED, BUCKET_BYTES, CHUNK = 24, 42, 32 << 20, 1024
#: Bucket offsets (16 bytes each) are broadcast up to this many buckets.
FEW_BUCKETS = 1 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """Uniformly random order of 0..n-1."""
    order = np.arange(n)
    picks = rng.integers(0, np.arange(n, 0, -1)) if n else order  # pick i from i..n-1
    for i, p in enumerate(picks.tolist()):
        j = i + p
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle_buckets(seed: int):
    """Shuffle each bucket of a partition sorted by bucket; one bucket in memory at a time."""
    def shuffled(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        bucket = rows.column("bucket")[0].as_py()
        keys = [rows.column(c).to_numpy() for c in ("crc", "size", "mark")]
        canonical = np.lexsort(keys)  # by mark, then size, then checksum: not the arrival order
        order = canonical[fisher_yates(len(canonical), np.random.default_rng([seed, bucket]))]
        places = pa.array(np.arange(len(order)), pa.int64())
        out = rows.take(pa.array(order)).append_column("place", places)
        yield from out.select(["bucket", "place", "size", "crc", "row"]).to_batches(max_chunksize=4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(ids)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ids)]):
                if held and held[0].column(0)[0].as_py() != int(ids[a]):
                    yield from shuffled(held)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from shuffled(held)

    return run


def write_shuffled(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Write all records in shuffled buckets below ``path``; returns the number of buckets.

    Columns written: bucket, place (in the bucket), size, crc, row (all input columns).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(text_col), F.lit(""))
    records = docs.select(
        F.xxhash64(F.lit(seed), *columns).alias("h1"), F.xxhash64(F.lit(seed + 1), *columns).alias("h2"),
        (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.struct("*").alias("row"))
    total = records.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # copies of a record are numbered, in chunks that are dealt out, and scatter like any other
    kept = one_of_each(records, ["h1", "h2"])
    first = kept.where("copies = 1").withColumn("copy", F.lit(0).cast("long")).drop("copies")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long")))
    chunks = kept.where("copies > 1").withColumn("chunk", chunk).repartition(parts, F.xxhash64("h1", "h2", "chunk"))
    more = chunks.withColumn("copy", F.explode(F.sequence(
        F.col("chunk"), F.least(F.col("chunk") + CHUNK, F.col("copies")) - 1))).drop("copies", "chunk")
    marked = first.unionByName(more).withColumn("mark", F.xxhash64(F.lit(seed), "h1", "h2", "copy"))
    # a task takes its buckets one after another: tasks are as many as the cluster is set for
    tasks = min(buckets, parts)
    bucket = F.pmod("mark", F.lit(buckets)).cast("int")
    dealt = marked.select(bucket.alias("bucket"), "size", "crc", "mark", "row").repartitionById(
        tasks, F.pmod("bucket", F.lit(tasks)).cast("int"))
    arrow_map(dealt.sortWithinPartitions("bucket"), _shuffle_buckets(seed), row_schema(
        "bucket int, place long, size long, crc long", row=dealt.schema["row"].dataType), rows=None).write.parquet(path)
    return buckets


def cut(written: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Give every written record its shard and slot; shard sizes differ by one at most."""
    counts = checkpointed(written.groupBy("bucket").agg(F.count("*").alias("n")))
    n_buckets, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return written.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    offsets = prefix_sums(counts, [F.col("bucket")], "n", "before").select(F.col("bucket").alias("of_bucket"), "before")
    at = written.join(F.broadcast(offsets) if n_buckets <= FEW_BUCKETS else offsets, F.col("bucket") == F.col("of_bucket"))
    whole = F.col("before") + F.col("place")
    shard = F.expr(f"cast(((before + place) * {shards}) div {total} as int)")
    first = F.expr(f"((cast(((before + place) * {shards}) div {total} as long) * {total}) + {shards - 1}) div {shards}")
    return at.select("bucket", "place", "size", "crc", "row", shard.alias("shard"),
                     (whole - first).alias("slot"))


def shards(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """All records with shard and slot, over the shuffled files (below the shared folder by default)."""
    spark = docs.sparkSession
    path = path or shared_folder(spark, "shuffled")
    write_shuffled(docs, path, id_col, text_col, seed, bucket_bytes)
    return cut(spark.read.parquet(path), n_shards)


def digest(sharded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of the query, from the written records."""
    return sharded.select(
        F.col("row").getField(id_col).alias("doc_id"), "size",
        F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
