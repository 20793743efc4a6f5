"""Operator 6: SimHash near-dedup with pigeonring candidate filtering.

Fingerprints: XXH64 (seed 42) of every word shingle, majority per bit.

Two fingerprints within ``max_bits`` differing bits are linked. The 64 bits
are cut into ``segments`` equal segments placed on a ring. By the pigeonring
principle a pair within the budget has a starting segment from which every run
of l consecutive segments differs in at most l * max_bits / segments bits. For
four segments and three bits: the first segment is equal, two differ in at
most one bit, three in at most two. Candidates are joined on a key of the
first *two* segments -- the second one also with each of its bits flipped on
one side -- so a key is 32 bits wide and buckets stay small; the longer runs
and then the full distance are checked in the join condition.

Only distinct fingerprints take part, so copies never meet in pairs. Linked
fingerprints become components by alternating large-star and small-star steps
(each a map-side combined minimum and a join), checkpointed in the shared
folder; nothing about documents reaches the driver but row counts.

Cases: a null or empty text has fingerprint zero and is linked like any other;
a null document id sorts after all others and is a component's id only if all
its ids are null; repeated rows share fingerprint and component and are each
returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, blobs, checkpointed, record_batch

SHINGLE, MAX_BITS, SEGMENTS, BITS = 3, 3, 4, 64
#: Hashes turned into bits at once; bounds memory for very long texts.
_BLOCK = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased words; 0 without words."""
    words = data.lower().split()  # bytes methods: A-Z only, and exactly the six blanks
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        rows = zip(*(words[i:] for i in range(shingle)))
        hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in rows]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[at:at + _BLOCK], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


_PRINT = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64())])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(b, shingle) for b in blobs(batch.column(2))], np.uint64)
            yield record_batch(_PRINT, [batch.column(0), batch.column(1),
                                        pa.array(fps.view(np.int64), pa.int64())])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp): fp holds the unsigned fingerprint's bits as a long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                       F.col(text_col).alias("text"))
    return arrow_map(rows, _prints(shingle), "doc_id long, row_key long, fp long")


def _segment(fp, k: int, segments: int):
    """Segment k (counted around the ring) of a fingerprint, as a long."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    k %= segments
    return F.shiftrightunsigned(fp, edges[k]).bitwiseAND(F.lit((1 << (edges[k + 1] - edges[k])) - 1))


def _width(k: int, segments: int) -> int:
    k %= segments
    return BITS * (k + 1) // segments - BITS * k // segments


def links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct values of ``fp`` within ``max_bits`` differing bits.

    Needs ``max_bits < segments``: then the first segment of a chain is equal and the second
    differs in one bit at most.
    """
    if not max_bits < segments or segments < 2:
        raise ValueError("the filter needs two segments, and more segments than differing bits")
    # a fixed number of partitions: each value grows into dozens of keys, which partitions merged
    # by the size of the values alone would not leave room for
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # (by another expression than the one they are distinct by: else Spark drops the repartition)
    values = prints.select("fp").distinct().repartition(parts, F.xxhash64("fp"))
    starts = range(segments)

    def keyed(flips: bool):
        keys = []
        for s in starts:
            head, second = _segment(F.col("fp"), s, segments), _segment(F.col("fp"), s + 1, segments)
            w = _width(s + 1, segments)
            # two segments may differ in floor(2 * max_bits / segments) bits: none or one
            masks = [0] + ([1 << i for i in range(w)] if flips and 2 * max_bits >= segments else [])
            keys += [F.struct(F.lit(s).cast("byte").alias("s"),
                              F.shiftleft(head, w).bitwiseOR(second.bitwiseXOR(F.lit(m))).alias("key"))
                     for m in masks]
        return values.select("fp", F.inline(F.array(*keys)))

    left = keyed(True).select(F.col("fp").alias("a"), F.col("s").alias("sa"), F.col("key").alias("ka"))
    right = keyed(False).select(F.col("fp").alias("b"), F.col("s").alias("sb"), F.col("key").alias("kb"))
    x = F.col("a").bitwiseXOR(F.col("b"))

    def chain(start: int):
        """Every run from ``start`` stays within its share of the budget."""
        test, total = F.lit(True), F.lit(0)
        for n in range(1, segments + 1):
            total = total + F.bit_count(_segment(x, start + n - 1, segments))
            test = test & (total <= n * max_bits // segments)
        return test

    viable = F.lit(False)
    for s in starts:
        viable = viable | ((F.col("sa") == s) & chain(s))
    pairs = left.join(right, (F.col("sa") == F.col("sb")) & (F.col("ka") == F.col("kb"))
                      & (F.col("a") < F.col("b")) & viable & (F.bit_count(x) <= max_bits))
    return pairs.select("a", "b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge: root is the smallest node of its component.

    Alternating large-star and small-star steps until the edges are stars.
    """
    pairs = checkpointed(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                         .where("u <> v").distinct())
    mark = None
    for _ in range(most_rounds):
        for large in (True, False):
            both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            if not large:  # small star: each node looks at its smaller neighbours only
                both = both.where("v < u")
            least = both.groupBy("u").agg(F.min("v").alias("m")).select(
                F.col("u").alias("c"), F.least("u", "m").alias("m"))
            moved = both.join(least, F.col("u") == F.col("c"))
            if large:
                moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            else:
                moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                    least.select(F.col("c").alias("u"), F.col("m").alias("v")))
            pairs = moved.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v")).distinct()
        pairs = checkpointed(pairs)
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """(doc_id, row_key, fp, component, component_id) per row.

    ``component`` is the smallest fingerprint (as a long) of the component,
    ``component_id`` its smallest document id.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    roots = components(links(prints, max_bits, segments))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = checkpointed(classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("component")))
    heads = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(heads, "component").select(F.col("fp").alias("own_fp"), "component",
                                                   "component_id")
    return prints.join(named, F.col("fp") == F.col("own_fp")).drop("own_fp")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component: its smallest id; among rows with that id (or without
    any) the smallest hash of all columns. Columns are those of ``docs``."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), whole.alias("__row"))
    prints = checkpointed(arrow_map(rows.select(F.col("__id").cast("long"), "__row", "__text"),
                                    _prints(shingle), "doc_id long, row_key long, fp long"))
    roots = components(links(prints, max_bits))
    # one row per fingerprint first (map-side combined), then one per component
    order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"),
                     F.col("row_key").alias("row"))
    best = prints.groupBy("fp").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    named = best.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.coalesce("root", "fp").alias("component"), "best")
    winners = checkpointed(named.groupBy("component").agg(F.min("best").alias("best")).select(
        F.coalesce("best.id", F.lit(0)).alias("__w_id"), F.col("best.no").alias("__w_no"),
        F.col("best.row").alias("__w_row")))
    # the row travels as one struct, so no column of the caller's can clash with the keys
    marked = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("k_id"),
                         F.col(id_col).isNull().alias("k_no"), whole.alias("k_row"))
    kept = marked.join(winners, (F.col("k_id") == F.col("__w_id")) & (F.col("k_no") == F.col("__w_no"))
                       & (F.col("k_row") == F.col("__w_row")), "left_semi")
    # rows equal in every column have equal keys; the join has put them in one partition already
    one = kept.dropDuplicates(["k_id", "k_no", "k_row"])
    return one.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(rows: DataFrame) -> DataFrame:
    """The columns of the query."""
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")
