"""Operator 2: line dedup by range partitioning, with keep bitmaps as result.

1. Every line becomes a light record: 128-bit hash of its key, document, row,
   position. No text travels.
2. The records are range-partitioned and sorted by (hash, document, row,
   position), so a line shared by a third of all documents is spread over many
   partitions instead of meeting in one. A checkpoint fixes the partitions.
3. Each partition tells its first and last hash and the document its last hash
   began with (three values per partition). From these the driver works out
   which document owns the hash that a partition starts with.
4. The partitions are streamed: a record whose document is not the first one
   of its hash is dropped. What leaves the stage is one compressed bitmap per
   document that loses lines.

Applying the bitmaps to the texts is a join of its own (``keep_lines``).

Cases: a null or empty text is one empty line, which is too short to be
shared; a null document id is one document that sorts after all others;
rows repeated with the same id belong to the same document, keep their lines
together and are each returned; an empty table gives an empty result; other
columns are carried along untouched by ``keep_lines``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import (BLANKS as _BLANKS, arrow_map, blobs, checkpointed, one_of_each, record_batch,
                                 row_schema)

MIN_CHARS = 10
BLANKS = _BLANKS.encode()


def line_key(line: bytes) -> bytes:
    """Stripped of blanks at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()  # bytes.lower() changes A-Z only


def _row_key(id_col, text_col):
    """Tells rows with the same id but different texts apart; equal rows are equal."""
    return F.xxhash64(id_col, text_col)


_RECORD = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("no_id", pa.bool_()), ("doc", pa.int64()),
                     ("row", pa.int64()), ("pos", pa.int32())])


def _records(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, counts, places = [], [], []
            for data in blobs(batch.column(3)):
                before = len(digests)
                for pos, line in enumerate(data.split(b"\n")):
                    key = line_key(line)
                    # a code point has four bytes at most, and one at least
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(
                            key.decode("utf-8", "replace")) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(pos)
                counts.append(len(digests) - before)
            hashes = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            docs = [np.repeat(c.to_numpy(zero_copy_only=False), counts) for c in batch.columns[:3]]
            yield record_batch(_RECORD, [pa.array(x, t) for x, t in zip(
                (hashes[:, 0], hashes[:, 1], *docs, np.array(places, np.int32)), _RECORD.types)])

    return run


def line_records(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, no_id, doc, row, pos) of every line long enough to be shared.

    Rows repeated with the same id and text are one document with the same lines: one stands for all."""
    rows = docs.select(F.col(id_col).isNull().alias("no_id"),
                       F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("doc"),
                       _row_key(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    rows = one_of_each(rows, ["no_id", "doc", "row"]).select("no_id", "doc", "row", "text")
    return arrow_map(rows, _records(min_chars),
                     "h1 long, h2 long, no_id boolean, doc long, row long, pos int")


_ORDER = ["h1", "h2", "no_id", "doc", "row", "pos"]
_EDGE = pa.schema([("part", pa.int32()), ("first1", pa.int64()), ("first2", pa.int64()),
                   ("first_no", pa.bool_()), ("first_doc", pa.int64()), ("last1", pa.int64()),
                   ("last2", pa.int64()), ("last_no", pa.bool_()), ("last_doc", pa.int64())])


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First hash of the partition, last hash, and the documents both began with."""
    first = last = part = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, no, doc, _, _, p = _columns(batch)
        part = int(p[0])
        first = first or (int(h1[0]), int(h2[0]), bool(no[0]), int(doc[0]))
        tail = (int(h1[-1]), int(h2[-1]))
        if last is None or last[:2] != tail:
            at = int(np.flatnonzero((h1 == tail[0]) & (h2 == tail[1]))[0])
            last = (*tail, bool(no[at]), int(doc[at]))
    rows = [(part, *first, *last)] if first else []
    yield record_batch(_EDGE, list(zip(*rows)) or [[]] * len(_EDGE))


def owners_at_start(edges: list[tuple]) -> dict[int, tuple]:
    """Per partition, the (hash, document) it inherits from the partitions before it."""
    out, held = {}, None
    for part, f1, f2, fno, fdoc, l1, l2, lno, ldoc in sorted(edges):
        if held and held[:2] == (f1, f2):
            out[part] = held
            if (l1, l2) == (f1, f2):
                continue  # the whole partition is one hash that began earlier
        held = (l1, l2, lno, ldoc)
    return out


_LOST = pa.schema([("no_id", pa.bool_()), ("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32())])


def _later_lines(owners: dict[int, tuple]):
    """Stream a sorted partition; emit the lines whose hash began in another document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, no, doc, row, pos, p = _columns(batch)
            if held is None:
                held = owners.get(int(p[0]))
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            starts = np.flatnonzero(new)
            own_no, own_doc = no[starts].copy(), doc[starts].copy()
            if held and held[:2] == (int(h1[0]), int(h2[0])):
                own_no[0], own_doc[0] = held[2:]
            group = np.cumsum(new) - 1
            lost = (own_no[group] != no) | (own_doc[group] != doc)
            held = (int(h1[-1]), int(h2[-1]), bool(own_no[-1]), int(own_doc[-1]))
            yield record_batch(_LOST, [pa.array(x[lost], t) for x, t in
                                       zip((no, doc, row, pos), _LOST.types)])

    return run


def pack(positions: list[int]) -> bytes:
    """Compressed keep bitmap: bit i is 0 if line i goes; lines past its end stay."""
    bits = np.ones(max(positions) + 1, np.uint8)
    bits[positions] = 0
    return zlib.compress(np.packbits(bits).tobytes() + (-len(bits) % 8).to_bytes(1, "big"))


def unpack(bitmap: bytes) -> np.ndarray:
    raw = zlib.decompress(bitmap)
    bits = np.unpackbits(np.frombuffer(raw[:-1], np.uint8))
    return bits[:len(bits) - raw[-1]].astype(bool)


_BITMAP = pa.schema([("no_id", pa.bool_()), ("doc", pa.int64()), ("row", pa.int64()),
                     ("n_dropped", pa.int64()), ("keep", pa.binary())])


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = [sorted(set(x)) for x in batch.column(3).to_pylist()]
        yield record_batch(_BITMAP, [*batch.columns[:3], [len(x) for x in at], [pack(x) for x in at]])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(no_id, doc, row, n_dropped, keep) of every row that loses lines; others keep all."""
    records = line_records(docs, id_col, text_col, min_chars)
    ranged = records.repartitionByRange(_partitions(docs), *_ORDER).sortWithinPartitions(*_ORDER)
    fixed = checkpointed(ranged.withColumn("part", F.spark_partition_id()))
    edges = arrow_map(fixed, _edges,
                      "part int, first1 long, first2 long, first_no boolean, first_doc long, "
                      "last1 long, last2 long, last_no boolean, last_doc long", rows=None)
    owners = owners_at_start([tuple(r) for r in edges.collect()])
    lost = arrow_map(fixed, _later_lines(owners), "no_id boolean, doc long, row long, pos int", rows=None)
    grouped = lost.groupBy("no_id", "doc", "row").agg(F.collect_list("pos").alias("pos"))
    return arrow_map(grouped, _pack_rows,
                     "no_id boolean, doc long, row long, n_dropped long, keep binary")


def _partitions(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_KEPT = pa.schema([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                   ("kept_sha256", pa.string())])


def _apply(want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.schema.names[2:]
            texts, counts, dropped, digests = [], [], [], []
            nulls = batch.column(0).is_null().to_pylist()
            for data, keep, null in zip(blobs(batch.column(0)), batch.column(1).to_pylist(), nulls):
                n = data.count(b"\n") + 1
                gone = 0
                if keep:
                    lines, bits = data.split(b"\n"), unpack(keep)
                    gone = int(len(bits) - bits.sum())
                    data = b"\n".join([x for x, k in zip(lines, bits) if k] + lines[len(bits):])
                if want_text:
                    texts.append(None if null else data.decode("utf-8", "replace"))
                counts.append(n)
                dropped.append(gone)
                digests.append(hashlib.sha256(data).hexdigest())
            cols = [pa.array(texts if want_text else [None] * len(counts), pa.string()),
                    pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(cols + batch.columns[2:], names=[*_KEPT.names, *rest])

    return run


def keep_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               want_text: bool = True) -> DataFrame:
    """Apply the bitmaps: (text, n_lines, n_dropped, kept_sha256, doc_id, row).

    ``row`` is a struct of all columns but the text, so no name can clash; the
    text is null where only the digests are wanted.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    left = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"),
                       F.struct(*(others if want_text else [F.col(id_col)])).alias("row"),
                       F.col(id_col).isNull().alias("l_no"),
                       F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("l_doc"),
                       _row_key(F.col(id_col), F.col(text_col)).alias("l_row"))
    marks = bitmaps.select("no_id", "doc", F.col("row").alias("b_row"), "keep")
    joined = left.join(marks, (F.col("l_no") == F.col("no_id")) & (F.col("l_doc") == F.col("doc"))
                       & (F.col("l_row") == F.col("b_row")), "left")
    wide = joined.select("text", "keep", "doc_id", "row")
    return arrow_map(wide, _apply(want_text), row_schema(
        "text string, n_lines long, n_dropped long, kept_sha256 string",
        doc_id=wide.schema["doc_id"].dataType, row=wide.schema["row"].dataType))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of the query, from the operator's bitmaps."""
    bitmaps = keep_bitmaps(docs, id_col, text_col)
    return keep_lines(docs, bitmaps, id_col, text_col, want_text=False).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256")


#: DuckDB SQL of the query.
DIGEST_SQL = """
WITH lines AS (
  SELECT d.doc_id, d.row_no, u.pos, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row_number() OVER () AS row_no,
               string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       LATERAL (SELECT unnest(d.parts) AS line, generate_subscripts(d.parts, 1) AS pos) u),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.*, (o.key IS NOT NULL AND l.doc_id <> o.owner) AS gone
  FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_no"""
