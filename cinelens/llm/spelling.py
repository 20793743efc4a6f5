"""Operator 12: spelling variant grouping over a bit-sliced position index.

1. Counting. Every text is cut into runs of letters; a run may be misspelt by a rule of the caller
   (the query's contract deletes a letter from about one in 97). Counts are combined in the
   worker, then per word on Spark; words long and frequent enough are the vocabulary.
2. Routing. Two words one edit apart agree, where the shorter has ``s`` letters, in the first
   ``s // 2`` letters or in the last ``s - s // 2``. So a word of ``m`` letters goes to four
   groups: by head and by tail, for ``s = m`` and ``s = m - 1``. Only words that can meet meet.
3. Index. A group's words are bit positions. For every (position, letter) one bitset tells the
   words with that letter there. A query word is read once; word-parallel recurrences carry four
   bitsets: no error so far, and one error as a replaced letter, as a letter more (index shifted
   by +1) or a letter less (shifted by -1). What is left at the end, by length, are the near words.
   A pair that agrees in head and tail counts in its head group only.
4. A group leaves one partial result per query word -- near words counted, the best of them -- and
   these are combined per word on Spark. No pair is ever written.
5. A word's form is its best near word if that is frequent enough. Roots follow the forms by
   doubling the step (a form is at least twice as frequent, so there is no ring).

Large groups: a group of more than ``tile`` words is cut into tiles by a hash of the word. Each
tile indexes its own words and takes all words of the group as queries, so a tile's memory is
bounded and a hot head or tail spreads over tasks.

Cases: a null or empty text has no words; a null id gives its rule the empty string as id;
repeated rows are counted each; equal counts prefer the smaller word in code-point order; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, blobs, checkpointed, record_batch

LEAST_CHARS, LEAST_COUNT, FORM_FACTOR, TILE = 5, 3, 2, 1 << 15
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words a worker holds before it hands its counts on.
_HELD = 1 << 18


def words_of(text: bytes) -> list[str]:
    """Maximal letter runs; only A-Z are lower-cased."""
    return _RUN.findall(text.lower().decode("utf-8", "replace"))  # bytes.lower() changes A-Z only


def deletion_noise(every: int = 97) -> Callable[[str, list[str]], list[tuple[str, str]]]:
    """Rule: (run, misspelt run) for the runs of a document whose checksum with its id ``every`` divides."""
    def rule(doc_id: str, runs: list[str]) -> list[tuple[str, str]]:
        start, crc = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32
        hit = [w for w in runs if not crc(w.encode(), start) % every]
        out = []
        for w in hit:
            k = crc(w.encode(), start) % len(w)
            out.append((w, w[:k] + w[k + 1:]))
        return out

    return rule


_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(rule, least_chars: int):
    def flush(held: Counter) -> pa.RecordBatch:
        rows = [(w, n) for w, n in held.items() if n > 0 and len(w) >= least_chars]
        return record_batch(_COUNT, [[w for w, _ in rows], [n for _, n in rows]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
                words = words_of(data)
                held.update(words)
                if rule:
                    for right, wrong in rule(doc_id or "", list(set(words))):
                        n = words.count(right)
                        held[right] -= n
                        held[wrong] += n
                if len(held) >= _HELD:
                    yield flush(held)
                    held = Counter()
        yield flush(held)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               rule: Callable | None = None, least_chars: int = LEAST_CHARS,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least that many code points and occurrences."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    counted = arrow_map(rows, _count(rule, least_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class BitSlicedIndex:
    """Per (position, letter) the words that have it there, as one integer's bits."""

    def __init__(self, words: list[str]):
        self.words = words
        self.slices: dict[str, dict[int, int]] = {}  # letter -> position -> bitset
        self.lengths: dict[int, int] = {}
        places: dict[tuple[str, int], list[int]] = {}
        sizes: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            sizes.setdefault(len(w), []).append(k)
            for p, c in enumerate(w):
                places.setdefault((c, p), []).append(k)
        for (c, p), at in places.items():
            self.slices.setdefault(c, {})[p] = self._bits(at)
        for m, at in sizes.items():
            self.lengths[m] = self._bits(at)

    def _bits(self, at: list[int]) -> int:
        raw = bytearray((len(self.words) + 7) // 8)
        for k in at:
            raw[k >> 3] |= 1 << (k & 7)
        return int.from_bytes(raw, "little")

    def near(self, word: str, of_length: set[int], not_head: int | None = None) -> int:
        """Bitset of the words one edit from ``word`` with a length in ``of_length``.

        With ``not_head``, words that share that many first letters are left out.
        """
        m, size = len(word), self.lengths.get
        same = size(m, 0) if m in of_length else 0
        more = size(m + 1, 0) if m + 1 in of_length else 0
        less = size(m - 1, 0) if m - 1 in of_length else 0
        alive = same | more | less
        replaced = added = missing = 0
        headed = alive if not_head == 0 else 0
        for i, c in enumerate(word):
            here = self.slices.get(c)
            at, after, before = (here.get(i, 0), here.get(i + 1, 0), here.get(i - 1, 0)) if here else (0, 0, 0)
            missing = (missing & before) | (alive & less)
            added = (added | (alive & more)) & after
            replaced = (replaced & at) | (alive & same & ~at)
            alive &= at
            if i + 1 == not_head:
                headed = alive
        return (replaced | added | (alive & more) | (missing & less)) & ~headed

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out


def _routes(vocab: DataFrame) -> DataFrame:
    """(kind, s, part, word, n): the groups of every word."""
    m = F.char_length("word")
    groups = []
    for s in (m, m - 1):
        half = F.floor(s / 2).cast("int")
        groups += [F.struct(F.lit("head").alias("kind"), s.alias("s"), half.alias("cut")),
                   F.struct(F.lit("tail").alias("kind"), s.alias("s"), (s - half).alias("cut"))]
    each = vocab.select("word", "n", F.explode(F.array(*groups)).alias("g")).where("g.s > 0")
    part = F.when(F.col("g.kind") == "head", F.left("word", F.col("g.cut"))).otherwise(
        F.right("word", F.col("g.cut")))
    return each.select(F.col("g.kind").alias("kind"), F.col("g.s").alias("s"), part.alias("part"), "word", "n")


_NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best", pa.string()),
                   ("best_n", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group, the words to index (query = 0) before the queries (1)."""
    group, held, index = None, [], None
    for batch in batches:
        found = []
        for kind, s, part, tile, query, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            key = (kind, s, part, tile)
            if key != group:
                group, held, index = key, [], None
            if not query:
                held.append((word, n))
                continue
            if index is None:
                index = BitSlicedIndex([w for w, _ in held])
            # the shorter word of a pair has s letters
            bits = index.near(word, {s, s + 1} if len(word) == s else {s}, s // 2 if kind == "tail" else None)
            if bits:
                near = [held[k] for k in index.members(bits)]
                best = min(near, key=lambda x: (-x[1], x[0]))
                found.append((word, n, len(near), *best))
        yield record_batch(_NEAR, list(zip(*found)) or [[]] * len(_NEAR))


def near_words(vocab: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best, best_n) of every word with a near word, by the index."""
    parts = int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routed = _routes(vocab)
    keys = ["kind", "s", "part"]
    sizes = routed.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1").select(
        *[F.col(k).alias(f"g_{k}") for k in keys], F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    met = routed.join(sizes, [F.col(k) == F.col(f"g_{k}") for k in keys])
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    roles = F.concat(F.array(F.struct(own.alias("tile"), F.lit(0).alias("query"))),
                     F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                                 lambda t: F.struct(t.alias("tile"), F.lit(1).alias("query"))))
    dealt = met.select(*keys, F.explode(roles).alias("r"), "word", "n").select(
        *keys, "r.tile", "r.query", "word", "n")
    ordered = dealt.repartition(parts, *keys, "tile").sortWithinPartitions(*keys, "tile", "query", "word")
    partial = arrow_map(ordered, _search, "word string, n long, n_near long, best string, best_n long")
    # the most frequent near word; of equals the smallest
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(word, root) of every row (word, form) that has a form: the last word that forms lead to."""
    steps = checkpointed(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    for _ in range(most_rounds):
        ahead = steps.select(F.col("word").alias("a_word"), F.col("root").alias("a_root"))
        # whoever's root has a form itself goes where that one has got to
        joined = steps.join(ahead, F.col("root") == F.col("a_word"), "left")
        steps = checkpointed(joined.select("word", F.coalesce("a_root", "root").alias("root"),
                                           F.col("a_word").isNotNull().alias("moved")))
        if not steps.where("moved").limit(1).count():
            return steps.select("word", "root")
        steps = steps.drop("moved")
    raise RuntimeError("forms make a ring")


def variant_groups(vocab: DataFrame, factor: int = FORM_FACTOR, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n)."""
    words = checkpointed(vocab.select("word", "n"))
    near = near_words(words, tile).withColumnRenamed("word", "near_word")
    found = checkpointed(words.join(near, F.col("word") == F.col("near_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= factor * F.col("n"), F.struct("best", "best_n")).alias("f")).select(
        "word", "n", "n_near", F.col("f.best").alias("form"), F.col("f.best_n").alias("form_n")))
    led = roots(found).withColumnRenamed("word", "led_word")
    return found.join(led, F.col("word") == F.col("led_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
