"""Operator 11: ranked lexical search by best-first document intervals.

Index (``build_index``): one row per document with its number of terms, the 64-bit hashes of its
distinct terms and how often each occurs, written below the shared folder. Every document and every
term is indexed; the index knows nothing of the queries and can serve any number of them.

Search (``search``): document-partitioned, map-only over the index.

1. A task turns its documents into blocks of bounded postings. Documents of a block that are alike
   in length and query terms score alike, so they become one entry with its smallest ids; entries
   are put in an order in which neighbours resemble each other (leading term, then length).
2. Every posting list (entries of one term, in that order) holds the score that the term adds to
   each entry, and a sparse table over these scores: level j names the largest of each run of 2^j
   postings, so the maximum of any range takes two look-ups (RMQ).
3. Per item, intervals of entries wait in order of their bound, the sum of the range maxima of the
   item's terms. The best are taken; each is split at the entry of its largest single range
   maximum. That entry is scored exactly (its postings are found by the split itself), both
   remaining intervals get their bound from new RMQs. An interval whose bound is below the item's
   k-th score so far is dropped; the k-th score is carried from block to block of the task.
4. Each task returns at most k documents per item; the best k of these are the answer.

Intervals are taken in batches of the best, which changes the order of work and not the result.
Scores are 64-bit integers (BM25-like, as in the query's contract); ties go to the smaller id.

Bounded: a block holds about ``block_postings`` postings; the items are taken in slices of about
``slice_bytes`` of text, each of which reads the index again. The driver and the tasks hold one
slice's terms and weights.

Cases: a null or empty text has no terms: it is no result, and an item without terms has no results;
a null id sorts after all others; repeated documents are results each; repeated items get their
results each; an empty table of either kind gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, blobs, record_batch, shared_folder, workers_find_us

TOP, BLOCK_POSTINGS, SLICE_BYTES, BATCH = 10, 1 << 20, 4 << 20, 128

# ASCII digits and letters (A-Z lower-cased) and all bytes of non-ASCII characters make terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int64())),
                    ("tfs", pa.list_(pa.int32()))])


def _hashes(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64).view(np.int64)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, sizes, hashes, tfs = [], [0], [], []
        for data in blobs(batch.column(1)):
            terms = terms_of(data)
            distinct = Counter(terms)
            counts.append(len(terms))
            sizes.append(sizes[-1] + len(distinct))
            hashes.append(_hashes(distinct))
            tfs.append(np.fromiter(distinct.values(), np.int32))
        cuts = pa.array(sizes, pa.int32())
        flat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.int64), (tfs, np.int32))]
        yield record_batch(_INDEX, [batch.column(0), counts, *(
            pa.ListArray.from_arrays(cuts, pa.array(x)) for x in flat)])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the index of all documents (below the shared folder by default) and return it."""
    path = path or shared_folder(docs.sparkSession, "postings")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    arrow_map(rows, _index_rows, "doc_id long, n long, terms array<long>, tfs array<int>",
              rows=256).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


class PostingBlock:
    """Posting lists of a block of documents with their sparse tables."""

    def __init__(self, entries: list[tuple], ids: list[list], weights: np.ndarray, total: tuple[int, int]):
        """``entries``: (n, term numbers, frequencies); ``ids``: their documents; ``total``: (N, L)."""
        self.ids = ids
        self.size = len(entries)
        lengths = np.array([e[0] for e in entries], np.int64)
        docs = np.repeat(np.arange(self.size), [len(e[1]) for e in entries])
        terms, tf = (np.concatenate([e[c] for e in entries]).astype(np.int64) for c in (1, 2))
        order = np.lexsort((docs, terms))
        self.doc, self.term, tf = docs[order], terms[order], tf[order]
        m = 25 + (75 * lengths * total[0]) // total[1]
        self.score = weights[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc]))
        self.key = self.term * self.size + self.doc
        # level j: the posting with the largest score of each run of 2^j (runs over the end of a
        # list are never asked for)
        longest = int(np.bincount(self.term).max())
        self.table = [np.arange(len(self.doc), dtype=np.int32)]
        while 2 << (len(self.table) - 1) <= longest:
            low, step = self.table[-1], 1 << (len(self.table) - 1)
            other = np.concatenate([low[step:], low[-step:]])
            self.table.append(np.where(self.score[other] > self.score[low], other, low))
        self.table = np.concatenate(self.table)

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """RMQ: the posting with the largest score of each non-empty range [a, b)."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        base = level.astype(np.int64) * len(self.doc)
        left, right = self.table[base + a], self.table[base + b - (1 << level)]
        return np.where(self.score[right] > self.score[left], right, left)

    def search(self, terms: np.ndarray, times: np.ndarray, best: TopK, batch: int = BATCH) -> None:
        """Offer to ``best`` every entry of the block that can be among the top."""
        a, b = np.searchsorted(self.term, terms), np.searchsorted(self.term, terms, "right")
        some = b > a
        owner, a, b, times = np.zeros(some.sum(), np.int64), a[some], b[some], times[some]
        wait = _Waiting(self, owner, a, b, times)
        while True:
            wait = wait.at_least(best.floor)
            if not len(wait.bound):
                return
            now, wait = wait.best(batch)
            # split at the entry of the largest single maximum of each interval
            value = self.score[now.arg] * now.times
            first = np.lexsort((-value, now.owner))[now.starts]
            at = self.doc[now.arg[first]][now.owner]
            p = np.searchsorted(self.key, self.term[now.a] * self.size + at)
            hit = (p < now.b) & (self.doc[np.minimum(p, len(self.doc) - 1)] == at)
            gain = np.where(hit, self.score[np.minimum(p, len(self.doc) - 1)] * now.times, 0)
            scores = np.add.reduceat(gain, now.starts)
            for k in np.flatnonzero(scores >= max(1, best.floor)):
                best.offer(int(scores[k]), self.ids[int(self.doc[now.arg[first[k]]])])
            owner = np.concatenate([2 * now.owner, 2 * now.owner + 1])
            a, b = np.concatenate([now.a, p + hit]), np.concatenate([p, now.b])
            keep = np.flatnonzero(b > a)
            keep = keep[np.argsort(owner[keep], kind="stable")]
            if len(keep):
                wait = wait.joined(_Waiting(self, owner[keep], a[keep], b[keep], np.tile(now.times, 2)[keep]))


class _Waiting:
    """Intervals, each with the ranges it has in the posting lists (sorted by interval)."""

    def __init__(self, block, owner, a, b, times, arg=None):
        self.block, self.a, self.b, self.times = block, a, b, times
        self.arg = block.largest(a, b) if arg is None else arg
        self.starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        self.owner = np.cumsum(np.r_[False, owner[1:] != owner[:-1]]) if len(owner) else owner
        value = block.score[self.arg] * times
        self.bound = np.add.reduceat(value, self.starts) if len(owner) else np.zeros(0, np.int64)

    def _only(self, chosen: np.ndarray) -> _Waiting:
        own = chosen[self.owner] if len(self.owner) else np.zeros(0, bool)
        return _Waiting(self.block, self.owner[own], self.a[own], self.b[own], self.times[own], self.arg[own])

    def at_least(self, floor: int) -> _Waiting:
        keep = self.bound >= max(1, floor)
        return self if keep.all() else self._only(keep)

    def best(self, n: int) -> tuple[_Waiting, _Waiting]:
        """The ``n`` intervals of the largest bound, and the others."""
        chosen = np.zeros(len(self.bound), bool)
        chosen[np.argpartition(-self.bound, n)[:n] if len(chosen) > n else slice(None)] = True
        return self._only(chosen), self._only(~chosen)

    def joined(self, other: _Waiting) -> _Waiting:
        if not len(self.bound):
            return other
        shift = len(self.bound)
        parts = [np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("a", "b", "times", "arg")]
        return _Waiting(self.block, np.concatenate([self.owner, other.owner + shift]), *parts)


class TopK:
    """The k best (score, id): larger scores first, then smaller ids, then rows without id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []
        self.floor = 0  # a smaller score cannot be among the best

    def offer(self, score: int, ids: list) -> None:
        for i in ids:
            key = (-score, i is None, i or 0)
            if len(self.rows) == self.k and key >= self.rows[-1]:
                return
            bisect.insort(self.rows, key)
            del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.floor = -self.rows[-1][0]


_FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search_task(slice_, k: int, block_postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights, total, queries = slice_.value
        tops = [TopK(k) for _ in queries]
        alike: dict[tuple, list] = {}
        held = 0

        def flush():
            nonlocal held
            if alike:
                rows = [((n, np.frombuffer(t, np.int32), np.frombuffer(f, np.int32)), _least(ids, k))
                        for (n, t, f), ids in alike.items()]
                # neighbours resemble each other: by their most frequent term, then by length
                rows.sort(key=lambda r: (int(r[0][1][np.argmax(r[0][2])]), r[0][0]))
                block = PostingBlock([r[0] for r in rows], [r[1] for r in rows], weights, total)
                for (terms, times), top in zip(queries, tops):
                    block.search(terms, times, top)
                alike.clear()
            held = 0

        for batch in batches:
            terms, cuts = _flat(batch.column(2))
            tfs, _ = _flat(batch.column(3))
            at = np.minimum(np.searchsorted(vocab, terms), len(vocab) - 1)
            known = vocab[at] == terms
            row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))[known]
            at, tfs = at[known].astype(np.int32), tfs[known]
            order = np.lexsort((at, row))
            at, tfs = at[order], tfs[order]
            ends = np.r_[0, np.cumsum(np.bincount(row, minlength=batch.num_rows))]
            for i, (doc, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                x, y = ends[i], ends[i + 1]
                if y > x:
                    ids = alike.setdefault((n, at[x:y].tobytes(), tfs[x:y].tobytes()), [])
                    if not ids:
                        held += y - x
                    ids.append(doc)
                    if len(ids) > 8 * k:  # of rows that score alike only the smallest ids can be results
                        ids[:] = _least(ids, k)
                    if held >= block_postings:
                        flush()
        flush()
        rows = [(q, None if no else i, -s) for q, top in enumerate(tops) for s, no, i in top.rows]
        yield record_batch(_FOUND, list(zip(*rows)) or [[]] * 3)

    return run


def _least(ids: list, k: int) -> list:
    return sorted(ids, key=lambda i: (i is None, i or 0))[:k]


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each list starts and ends."""
    cuts = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[cuts[0]:cuts[-1]], cuts - cuts[0]


def _document_counts(vocab: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocab), np.int64)
        for batch in batches:
            terms, _ = _flat(batch.column(0))
            at = np.minimum(np.searchsorted(vocab, terms), len(vocab) - 1)
            counts += np.bincount(at[vocab[at] == terms], minlength=len(vocab))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], names=["t", "df"])

    return run


def _search_slice(index: DataFrame, texts: list[tuple[str, str]], total: tuple[int, int], k: int,
                  block_postings: int) -> DataFrame:
    """(key, doc_id, score): up to k per key and task."""
    spark = index.sparkSession
    counted = [(key, Counter(terms_of(text.encode()))) for key, text in texts]
    counted = [(key, c) for key, c in counted if c]
    vocab = np.unique(np.concatenate([_hashes(c) for _, c in counted])) if counted else np.zeros(0, np.int64)
    empty = spark.createDataFrame([], "key string, doc_id long, score long")
    if not len(vocab) or not total[1]:
        return empty
    df = np.zeros(len(vocab), np.int64)
    for t, n in arrow_map(index.select("terms"), _document_counts(vocab), "t long, df long", rows=None).groupBy(
            "t").agg(F.sum("df").alias("df")).collect():  # as many rows as the slice has terms at most
        df[t] = n
    weights = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    queries = []
    for _, c in counted:
        terms, times = np.searchsorted(vocab, _hashes(c)), np.fromiter(c.values(), np.int64)
        useful = weights[terms] > 0
        order = np.argsort(terms[useful])
        queries.append((terms[useful][order], times[useful][order]))
    shared = spark.sparkContext.broadcast((vocab, weights, total, queries))
    found = arrow_map(index, _search_task(shared, k, block_postings), "query long, doc_id long, score long", rows=None)
    keys = spark.createDataFrame([(q, key) for q, (key, _) in enumerate(counted)], "q long, key string")
    return found.join(F.broadcast(keys), F.col("query") == F.col("q")).select("key", "doc_id", "score")


def search(index: DataFrame, items: DataFrame, k: int = TOP, item_col: str = "item_id", text_col: str = "text",
           slice_bytes: int = SLICE_BYTES, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the index that score best for each item."""
    spark = index.sparkSession
    workers_find_us(spark)
    total = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = items.select(F.col(item_col).alias("item_id"), F.md5(F.col(text_col).cast("binary")).alias("item_key"),
                         F.col(text_col).alias("text")).where("text IS NOT NULL")
    texts = asked.groupBy("item_key").agg(F.min("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    found = None
    for s in range(slices):
        own = texts.where(F.pmod(F.xxhash64("item_key"), F.lit(slices)) == s).collect()
        part = _search_slice(index, [tuple(r) for r in sorted(own)], tuple(total), k, block_postings)
        if slices > 1:  # one slice's work at a time
            path = shared_folder(spark, "found")
            part.write.parquet(path)
            part = spark.read.parquet(path)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(best, F.col("item_key") == F.col("key")).select("item_id", "rank", "doc_id", "score")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of the query: index all documents, search all items."""
    return search(build_index(docs), items)


#: DuckDB SQL of the query.
DIGEST_SQL = r"""
WITH doc_terms AS (
  SELECT row_no, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row_no FROM documents)),
item_terms AS (
  SELECT item_no, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS item_no FROM benchmark)),
sizes AS (SELECT row_no, doc_id, count(*) AS n FROM doc_terms GROUP BY row_no, doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
asked AS (SELECT item_no, item_id, term, count(*) AS times FROM item_terms GROUP BY item_no, item_id, term),
tfs AS (SELECT row_no, term, count(*) AS tf FROM doc_terms
        WHERE term IN (SELECT term FROM asked) GROUP BY row_no, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
scored AS (
  SELECT a.item_no, a.item_id, s.doc_id, s.row_no,
         CAST(sum(a.times * w.w * ((1000000000 * t.tf)
              // (1000 * t.tf + 8 * (25 + (75 * s.n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked a JOIN tfs t USING (term) JOIN weights w USING (term) JOIN sizes s USING (row_no), total
  GROUP BY a.item_no, a.item_id, s.doc_id, s.row_no),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id) AS INTEGER) AS "rank"
  FROM scored WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 10"""
