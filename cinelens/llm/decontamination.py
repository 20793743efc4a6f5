"""Operator 10: benchmark decontamination with one Aho-Corasick automaton.

The benchmark texts are normalised to words and cut into windows; all windows
go into one automaton, which reads every normalised document once. Matches are
mapped back to word positions and to spans of the original text.

The automaton is broadcast only while the benchmark's windows stay below
``slice_bytes`` (their size is summed first). A larger benchmark is cut into
slices by item, each with an automaton below the bound; the hits of the slices
are then merged per document, so results are whole at any size.

Cases: a null text has no words and is neither hit nor a window; a null item
id is scanned but cannot be listed (its hits count in ``n_hit``, not in
``n_items``); items sharing an id count once; repeated documents are each
answered for; empty tables give zero hits or an empty result. Only the id and
text columns are read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, blobs, record_batch, row_schema

WINDOW = 10
#: Most bytes of window text in one broadcast automaton (some forty times that in memory).
SLICE_BYTES = 8 << 20

# ASCII letters and digits (lower-cased) and every non-ASCII byte belong to words.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
                for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_NORMAL).split()


def windows_of(data: bytes, size: int = WINDOW) -> list[bytes]:
    w = words_of(data)
    if not w:
        return []
    return [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item", pa.string()), ("window", pa.string())])
    for batch in batches:
        items, wins = [], []
        for item, data in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
            for w in sorted(set(windows_of(data))):
                items.append(item)
                wins.append(w.decode("utf-8", "replace"))
        yield record_batch(schema, [items, wins])


_AUTOMATA: dict[str, tuple] = {}


def build_automaton(patterns: list[tuple[str, list]]) -> tuple:
    """(automaton, words of each pattern, items of each pattern).

    One byte is one character, so offsets in the automaton are byte offsets.
    """
    auto = ahocorasick.Automaton()
    for k, (window, _) in enumerate(patterns):
        auto.add_word(" " + window.encode().decode("latin-1") + " ", k)
    if patterns:
        auto.make_automaton()
    return auto, [w.count(" ") + 1 for w, _ in patterns], [items for _, items in patterns]


def _automaton(broadcast) -> tuple:
    """The broadcast's automaton, built once per worker; one is kept at a time."""
    token, patterns = broadcast.value
    if token not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[token] = build_automaton(patterns)
    return _AUTOMATA[token]


def scan_text(data: bytes, auto, sizes: list[int], owners: list) -> tuple[int, np.ndarray, set]:
    """Words, sorted positions of hit words, and ids of the items that occur."""
    words = words_of(data)
    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
    matches = list(auto.iter(text)) if sizes and words else []
    if not matches:
        return len(words), np.empty(0, np.int64), set()
    blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    ends = np.searchsorted(blanks, np.array([e for e, _ in matches]))
    starts = ends - np.array([sizes[k] for _, k in matches])
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    items = set().union(*(owners[k] for k in {k for _, k in matches}))
    return len(words), np.flatnonzero(np.cumsum(edge)[:-1] > 0), items


def original_spans(data: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code point spans of the runs of hit words in the original text."""
    if not len(hit):
        return []
    places = [m.span() for m in _WORD.finditer(data.lower())]
    breaks = np.flatnonzero(np.diff(hit) > 1)
    firsts, lasts = np.r_[hit[0], hit[breaks + 1]], np.r_[hit[breaks], hit[-1]]
    out, done, points = [], 0, 0
    for a, b in zip(firsts, lasts):
        span = []
        for at in (places[a][0], places[b][1]):
            points += len(data[done:at].decode("utf-8", "replace"))
            done = at
            span.append(points)
        out.append(tuple(span))
    return out


_ROW = "doc_id long, row_key long, n_words long, hit_words array<long>, items array<string>, spans string"
_ROW_ARROW = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_words", pa.int64()),
                        ("hit_words", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
                        ("spans", pa.string())])


def _written(spans: list[tuple[int, int]]) -> str:
    return ",".join(f"{a}:{b}" for a, b in spans)


def _scanner(broadcast, only_hits: bool):
    """Scan (doc_id, row_key, text) rows; ``only_hits`` leaves out documents without a hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, sizes, owners = _automaton(broadcast)
        for batch in batches:
            rows = []
            for doc, key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      blobs(batch.column(2))):
                n, hit, items = scan_text(data, auto, sizes, owners)
                if len(hit) or not only_hits:
                    spans = "" if only_hits else _written(original_spans(data, hit))
                    rows.append((doc, key, n, hit, sorted(items), spans))
            yield record_batch(_ROW_ARROW, list(zip(*rows)) or [[]] * 6)

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and spans of documents whose hits were merged from several slices."""
    for batch in batches:
        hits = [np.array(h or [], np.int64) for h in batch.column(3).to_pylist()]
        texts = blobs(batch.column(2))
        yield record_batch(_ROW_ARROW, [
            batch.column(0), batch.column(1), [len(words_of(t)) for t in texts], hits,
            [x or [] for x in batch.column(4).to_pylist()],
            [_written(original_spans(t, h)) for t, h in zip(texts, hits)]])


def item_patterns(benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[DataFrame, int]:
    """(window, items) of a benchmark, and the bytes an automaton of them all is held to need."""
    windows = arrow_map(benchmark.select(F.col(item_col).cast("string").alias("item"),
                                         F.col(item_text_col).alias("text")),
                        _item_windows, "item string, window string")
    total = windows.agg(F.sum(F.octet_length("window") + 32)).first()[0] or 0
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")), total


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: doc_id, row_key, n_words, hit_words (positions), items (ids), spans.

    ``spans`` are start:end code points of hit passages in the original text.
    ``row_key`` tells rows with the same id but another text apart.
    """
    spark = docs.sparkSession
    patterns, total = item_patterns(benchmark, item_col, item_text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                       F.col(text_col).alias("text"))
    if total <= slice_bytes:
        return arrow_map(rows, _scanner(_broadcast(spark, patterns), False), _ROW)
    n_slices = -(-2 * total // slice_bytes)  # about half full each
    patterns = patterns.withColumn("slice", F.pmod(F.xxhash64("window"), F.lit(n_slices)))
    hits = None
    for k in range(n_slices):
        mine = _broadcast(spark, patterns.where(F.col("slice") == k))
        found = arrow_map(rows, _scanner(mine, True), _ROW).dropDuplicates(["doc_id", "row_key"])
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy("doc_id", "row_key").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).select(
        F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key"), "hit_words", "items")
    joined = rows.join(merged, F.col("doc_id").eqNullSafe(F.col("hit_id"))
                       & (F.col("row_key") == F.col("hit_key")), "left")
    return arrow_map(joined.select("doc_id", "row_key", "text", "hit_words", "items"), _finish, _ROW)


def _broadcast(spark, patterns: DataFrame):
    """Broadcast (window, items) pairs; the caller has checked their size."""
    rows = sorted((r["window"], sorted(r["items"])) for r in patterns.select("window", "items").collect())
    return spark.sparkContext.broadcast((uuid.uuid4().hex, rows))


def _cleaner(broadcast, text_col: str):
    """Pass on the rows whose text holds no window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, sizes, _ = _automaton(broadcast)
        for batch in batches:
            clean = []
            rows = batch.column(0)
            for data in blobs(rows.field(text_col)):
                text = (b" " + b" ".join(words_of(data)) + b" ").decode("latin-1")
                clean.append(not sizes or next(auto.iter(text), None) is None)
            yield pa.RecordBatch.from_arrays([rows.filter(pa.array(clean, pa.bool_()))], names=["row"])

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit word, all columns kept.

    With one automaton the rows are filtered where they are; with several slices the keys of
    contaminated rows are anti-joined.
    """
    patterns, total = item_patterns(benchmark, item_col, item_text_col)
    if total <= slice_bytes:
        rows = docs.select(F.struct("*").alias("row"))
        kept = arrow_map(rows, _cleaner(_broadcast(docs.sparkSession, patterns), text_col),
                         row_schema("", row=rows.schema["row"].dataType))
        return kept.select([F.col("row").getField(c).alias(c) for c in docs.columns])
    hits = scan_benchmark(docs, benchmark, id_col, text_col, item_col, item_text_col, slice_bytes).where(
        F.size("hit_words") > 0).select(F.col("doc_id").alias("__hit_id"),
                                        F.col("row_key").alias("__hit_key")).distinct()
    left = docs.select(F.struct("*").alias("row"))
    own = F.col("row").getField(id_col).cast("long")
    key = F.xxhash64(F.col("row").getField(id_col), F.col("row").getField(text_col))
    kept = left.join(hits, own.eqNullSafe(F.col("__hit_id")) & (key == F.col("__hit_key")), "left_anti")
    return kept.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the query, from the operator's rows."""
    return scanned.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


#: DuckDB SQL of the query.
DIGEST_SQL = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT DISTINCT id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) u
  WHERE len(w) > 0),
docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sized AS (SELECT d.row_no, d.w, s.n FROM docs d JOIN (SELECT DISTINCT n FROM wins) s ON len(d.w) >= s.n),
doc_wins AS (
  SELECT row_no, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM sized, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) u),
hits AS (SELECT d.row_no, d.i, d.n, x.id FROM doc_wins d JOIN wins x ON d.win = x.win AND d.n = x.n),
places AS (
  SELECT row_no, count(DISTINCT p) AS n_hit
  FROM (SELECT row_no, p FROM hits, LATERAL (SELECT unnest(range(i, i + n)) AS p) u) t GROUP BY row_no),
found AS (
  SELECT row_no, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
  FROM hits GROUP BY row_no)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p ON d.row_no = p.row_no LEFT JOIN found f ON d.row_no = f.row_no"""
