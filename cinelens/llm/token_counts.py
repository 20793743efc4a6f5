"""Operator 9: token counts with a two-tier table of pre-token lengths.

Byte-level BPE works on pre-tokens, each for itself, so the token count of a
text is the sum over its pre-tokens. Tier one is a compact table of the
lengths of frequent pre-tokens, broadcast to all workers; tier two is a cache
in each worker, filled by the tokenizer itself for what tier one misses. No
pre-token is ever shuffled, and counts are exact whatever the tiers hold.

Bounds: tier one holds at most ``table_size`` pre-tokens of at most
``longest`` bytes, the frequent ones of all documents by bounded summaries per
task; tier two is emptied when it holds ``cache_size`` entries.

Texts that hold one of the tokenizer's added tokens (special strings) go to
the tokenizer whole, as do texts under a tokenizer that does more than split
and merge (normalizer, prefix space, truncation).

Cases: a null text is empty (0 bytes, 0 tokens); a null id stays null;
repeated rows are counted each for themselves; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, checkpointed, record_batch

LIMIT = 1024
TABLE_SIZE, CACHE_SIZE, LONGEST = 50_000, 1_000_000, 64

#: The split of byte-level BPE: public pattern of this tokenizer family (fixed value).
SPLIT = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


class Lengths:
    """Token counts by the tokenizer file, with the worker's own cache."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        split = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.splits = (spec["normalizer"] is None and split.get("type") == "ByteLevel"
                       and not split.get("add_prefix_space") and split.get("use_regex", True))
        self.cache: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str, table: dict[str, int], cache_size: int = CACHE_SIZE) -> int:
        if not self.splits or any(a in text for a in self.added):
            return self.whole(text)
        total, own, misses = 0, self.cache, Counter()
        for piece in SPLIT.findall(text):
            n = table.get(piece) or own.get(piece)
            if n:
                total += n
            else:
                misses[piece] += 1
        if misses:
            if len(own) > cache_size:
                own.clear()
            pieces = list(misses)
            for piece, e in zip(pieces, self.tokenizer.encode_batch(pieces, add_special_tokens=False)):
                own[piece] = n = len(e.ids)
                total += n * misses[piece]
        return total


_LENGTHS: dict[str, Lengths] = {}


def lengths(path: str) -> Lengths:
    """One per worker and file, so the cache lives as long as the worker."""
    if path not in _LENGTHS:
        _LENGTHS[path] = Lengths(path)
    return _LENGTHS[path]


_PIECE = pa.schema([("piece", pa.string()), ("n", pa.int64())])


def _top_pieces(size: int, longest: int):
    """Counts of the frequent pre-tokens of a task: whenever four times ``size`` are held, the rarer half goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(SPLIT.findall(text or ""))
                if len(seen) > 4 * size:
                    seen = Counter(dict(seen.most_common(2 * size)))
        top = [(p, n) for p, n in seen.most_common(size) if n > 1 and len(p.encode()) <= longest]
        yield record_batch(_PIECE, [[p for p, _ in top], [n for _, n in top]])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str, table_size: int, longest: int) -> dict[str, int]:
    """Tier one: token counts of the pre-tokens that are frequent in all documents.

    Each task's summary of at most ``table_size`` counts is added up on Spark. A histogram of the sums
    (64 classes a power of two) tells from which class on no more than ``table_size`` remain; only
    these come to the driver.
    """
    counted = arrow_map(docs.select(F.col(text_col).alias("text")), _top_pieces(table_size, longest),
                        "piece string, n long")
    sums = checkpointed(counted.groupBy("piece").agg(F.sum("n").alias("n")).withColumn(
        "rank", F.floor(64 * F.log2("n")).cast("int")))
    ranks = sorted((tuple(r) for r in sums.groupBy("rank").count().collect()), reverse=True)
    least, held = None, 0
    for rank, n in ranks:
        held += n
        if held > table_size:
            break
        least = rank
    if least is None:
        return {}
    pieces = sorted(r["piece"] for r in sums.where(F.col("rank") >= least).select("piece").collect())
    found = lengths(path).tokenizer.encode_batch(pieces, add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, found)}


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _counter(path: str, broadcast, cache_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = lengths(path), broadcast.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield record_batch(_COUNTS, [batch.column(0), [len(t.encode()) for t in texts],
                                         [own.count(t, table, cache_size) for t in texts]])

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 table_size: int = TABLE_SIZE,
                 cache_size: int = CACHE_SIZE, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    table = frequent_lengths(docs, path, text_col, table_size, longest) if lengths(path).splits else {}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, _counter(path, shared, cache_size), "doc_id long, n_bytes long, n_tokens long")


def digest(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counts.select("doc_id", "n_bytes", "n_tokens",
                         (F.col("n_tokens") > limit).alias("over_limit"))
