"""Operator 3: whole, balanced, gapless, reproducible, uniformly shuffled."""

import zlib
from collections import Counter

import numpy as np

from cinelens.llm import sharding
from cinelens.llm.queries import op3_sharding

from llm_cases import ODD, SF01, clashing


def check(rows, shards, texts):
    """``rows``: (doc_id, size, crc, shard, slot); ``texts``: (doc_id, text) of the input."""
    want = Counter((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter(r[:3] for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[4])
    sizes = [len(by.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def five(df):
    return [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in df.collect()]


def test_query(spark, docs01):
    df = op3_sharding(spark, SF01)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = five(df)
    check(rows, 24, docs01.items())
    assert {r.law for r in df.collect()} == {"rows"}


def test_odd_rows_in_small_buckets(spark, odd):
    df = clashing(odd, "shard", "slot", "bucket", "size", "crc")
    rows = five(sharding.digest(sharding.shards(df, 4, bucket_bytes=20_000)))
    check(rows, 4, [(i, t) for i, t, *_ in ODD])


def test_more_shards_than_rows_and_one_shard(spark, odd):
    for k in (1, 100):
        check(five(sharding.digest(sharding.shards(odd, k))), k, [(i, t) for i, t, *_ in ODD])


def test_empty_table(none):
    assert sharding.digest(sharding.shards(none)).collect() == []


def test_all_columns_are_kept(spark, odd):
    out = sharding.shards(clashing(odd, "shard"), 3)
    assert out.schema["row"].dataType.fieldNames() == [*odd.columns, "shard", "odd name-1.x"]


def test_same_input_same_shards(spark):
    a, b = (sorted(five(sharding.digest(sharding.shards(
        spark.read.parquet(f"{SF01}/documents.parquet"), bucket_bytes=300_000)))) for _ in range(2))
    assert a == b


def test_copies_of_one_row_do_not_share_a_bucket(spark):
    df = spark.createDataFrame([(1, "the same text")] * 4000, "doc_id long, text string").repartition(40)
    path = sharding.shared_folder(spark, "test")
    sharding.write_shuffled(df, path, bucket_bytes=8_000)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("bucket").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1200


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(1)
    seen = Counter(tuple(sharding.fisher_yates(3, rng).tolist()) for _ in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())
    assert sharding.fisher_yates(0, rng).tolist() == [] and sharding.fisher_yates(1, rng).tolist() == [0]


def test_shards_mix_the_input(spark):
    rows = five(sharding.digest(sharding.shards(
        spark.read.parquet(f"{SF01}/documents.parquet"), 4, bucket_bytes=300_000)))
    means = [np.mean([r[0] for r in rows if r[3] == k]) for k in range(4)]
    assert max(means) - min(means) < 120  # ids 0..999: about 40 expected


def test_shards_do_not_depend_on_the_partitions(spark, odd):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.limit(0)).unionByName(odd.select("doc_id", "text"))
    many = docs.unionByName(spark.createDataFrame([(5, "again and again")] * 3000, "doc_id long, text string"))
    one, two, three = (sorted(five(sharding.digest(sharding.shards(d, bucket_bytes=100_000))), key=repr) for d in (
        many.repartition(1), many.repartition(7), many.repartition(5, "text")))
    assert one == two == three and len(one) == 1000 + len(ODD) + 3000


def test_order_is_the_buckets_fisher_yates(spark, odd):
    """The whole shuffle once more, from the marks alone."""
    from pyspark.sql import functions as F
    n_buckets, path = 5, sharding.shared_folder(spark, "test")
    docs = odd.where("doc_id IS NOT NULL").select("doc_id", "text").dropDuplicates()
    docs = docs.unionByName(spark.createDataFrame([(100 + i, f"text {i}") for i in range(300)], "doc_id long, text string"))
    size = sum(8 + len((r.text or "").encode()) for r in docs.collect())
    assert sharding.write_shuffled(docs, path, bucket_bytes=-(-size // n_buckets)) == n_buckets
    marks = docs.select("doc_id", F.xxhash64(F.lit(42), "doc_id", "text").alias("h1"), F.xxhash64(F.lit(43), "doc_id", "text").alias("h2")) \
        .select("doc_id", F.xxhash64(F.lit(42), "h1", "h2", F.lit(0).cast("long")).alias("mark")).collect()
    order = []
    for b in range(n_buckets):
        own = sorted((r.mark, r.doc_id) for r in marks if r.mark % n_buckets == b)
        order += [own[k][1] for k in sharding.fisher_yates(len(own), np.random.default_rng([42, b]))]
    got = {(r.shard, r.slot): r.row.doc_id for r in sharding.cut(spark.read.parquet(path), 7).collect()}
    n = len(order)
    want = {}
    for k, doc in enumerate(order):
        shard = k * 7 // n
        want[shard, k - -(-shard * n // 7)] = doc
    assert got == want
