"""Operator 8: toxicity by a classifier chain.

Categories are predicted one after another. The model of each category sees
the features of the text and the probabilities of the categories before it; in
training these are out-of-fold probabilities, so later models learn from the
kind of input they will meet. The last category is the verdict.

Features are counts of telling words and word beginnings (three to six
characters, so that forms of a stem count together). They are chosen over the
labelled sample by likelihood ratio towards the last category; of a word and
its beginnings only the most telling one is taken.

The given labels say only whether a document is toxic, so the chain's earlier
categories are severities derived from it: uses telling words at all, uses
several, uses them densely. Callers with category labels of their own pass
those columns instead.

Training uses at most about ``train_rows`` labelled rows, each id and text once (chosen by
hashes), and ``vocabulary`` features; these numbers are parameters. Everything
else covers all documents: scoring is map-only, with the model (a few
kilobytes) sent along.

Cases: a null text has no words and gets the model's intercept; a document
without label is scored like any other; repeated labels of an id count as its
highest; with no labelled rows nothing is toxic; repeated rows are scored each
for themselves; null ids stay null; an empty table gives an empty result;
``score`` keeps other columns in a struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelens.llm import logistic
from cinelens.llm.common import arrow_map, blobs, bounded_sample, checkpointed, record_batch, row_schema
from cinelens.llm.decontamination import words_of

TRAIN_ROWS, VOCABULARY, FOLDS, RIDGE, MIN_DOCS, THRESHOLD = 20_000, 128, 5, 1.0, 5, 0.5
STEMS, LONGEST_WORD, CACHE_SIZE = (3, 4, 5, 6), 40, 500_000
#: Severities derived from the label: several telling words, and their least share of all words.
SEVERAL, DENSE = 4, 0.03
SEVERITIES = ["mentions", "repeated", "dense"]


def forms(word: bytes) -> list[str]:
    """The word itself and its beginnings; of a word over ``LONGEST_WORD`` code points the beginnings."""
    w = word.decode("utf-8", "replace")
    return ["=" + w] * (len(w) <= LONGEST_WORD) + ["^" + w[:k] for k in STEMS if len(w) > k]


def _sampled(labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the ids at most, by a hash of the id."""
    n = labels.count()
    if n <= rows:
        return labels
    return labels.where(F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * rows / n))


class Chain:
    """Features and one weight vector per category."""

    def __init__(self, features: list[str], categories: list[str], ridge: float):
        self.index = {w: i for i, w in enumerate(features)}
        self.categories, self.ridge, self.weights = categories, ridge, []
        self.known: dict[bytes, tuple[int, ...]] = {}  # word -> its features, per worker

    def features(self, data: bytes) -> np.ndarray:
        """log(1 + count) of each feature and of all, and the share of telling words."""
        counts = np.zeros(len(self.index) + 2)
        words, known, telling = words_of(data), self.known, 0
        for w in words:
            at = known.get(w)
            if at is None:
                if len(known) > CACHE_SIZE:
                    known.clear()
                at = known[w] = tuple(self.index[f] for f in forms(w) if f in self.index)
            if at:
                telling += 1
                for i in at:
                    counts[i] += 1
        counts[-2] = telling
        out = np.log1p(counts)
        out[-1] = telling / max(1, len(words))
        return out

    def train(self, x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> None:
        self.train_wide(np.c_[x, np.zeros((len(x), len(self.categories) - 1))], y, folds)

    def train_wide(self, x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> None:
        """``x``: the features, then a column for each category but the last, which is filled here."""
        width = x.shape[1] - len(self.categories) + 1
        for k in range(len(self.categories)):
            seen = x[:, :width + k]
            self.weights.append(logistic.fit(seen, y[:, k], self.ridge))
            if k + 1 < len(self.categories):
                x[:, width + k] = logistic.out_of_fold(seen, y[:, k], folds, self.ridge)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, one column per category."""
        for w in self.weights:
            x = np.c_[x, logistic.predict(x, w)]
        return x[:, x.shape[1] - len(self.weights):]


def severities(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels of the derived categories, from features and the 0/1 label."""
    telling, share = np.expm1(x[:, -2]), x[:, -1]
    return np.c_[label * (telling >= 1), label * (telling >= SEVERAL), label * (share >= DENSE)]


_FORMS = pa.schema([("forms", pa.list_(pa.string())), ("y", pa.list_(pa.int32()))])


def _distinct_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted({f for w in set(words_of(b)) for f in forms(w)}) for b in blobs(batch.column(0))]
        yield record_batch(_FORMS, [found, batch.column(1)])


def telling_features(sample: DataFrame, size: int, min_docs: int) -> list[str]:
    """Forms whose presence speaks most for the last label, at most ``size``, one per stem."""
    base = sample.agg(F.count("*"), F.sum(F.element_at("y", -1))).first()
    n, pos = base[0], base[1] or 0
    if not n or not pos or pos == n:
        return []
    found = arrow_map(sample.select("text", "y"), _distinct_forms, "forms array<string>, y array<int>", rows=256)
    df = found.select(F.explode("forms").alias("form"), F.element_at("y", -1).alias("hit")).groupBy(
        "form").agg(F.count("*").alias("n"), F.sum("hit").alias("k"))
    p = pos / n
    k, m = F.col("k"), F.col("n")

    def part(k, m, p) -> Column:
        return F.when(k > 0, k * F.log(k / (m * p))).otherwise(0.0)

    ratio = part(k, m, p) + part(m - k, m, 1 - p) + part(pos - k, n - m, p) + part(
        (n - m) - (pos - k), n - m, 1 - p)
    ranked = df.where((m >= min_docs) & (k > m * p)).select("form", ratio.alias("g")).orderBy(
        F.desc("g"), F.desc(F.length("form")), "form").limit(50 * size).collect()
    taken: list[str] = []
    for form, _ in ranked:
        w = form[1:]
        if not any(w.startswith(t[1:]) or t[1:].startswith(w) for t in taken):
            taken.append(form)
        if len(taken) == size:
            break
    return taken


def _featurizer(chain: Chain):
    """The features that are not zero, by their numbers ``at``."""
    schema = pa.schema([("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float64())), ("y", pa.list_(pa.int32())),
                        ("fold", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [chain.features(b) for b in blobs(batch.column(0))]
            at = [np.flatnonzero(v) for v in x]
            yield record_batch(schema, [at, [v[i] for v, i in zip(x, at)], batch.column(1), batch.column(2)])

    return run


def matrix(at: pa.ListArray, values: pa.ListArray, width: int) -> np.ndarray:
    """Rows of ``width`` numbers from those that are not zero."""
    x = np.zeros((len(at), width))
    rows = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
    x[rows, at.flatten().to_numpy()] = values.flatten().to_numpy()
    return x


def train(labelled: DataFrame, label_cols: list[str], derive: bool = False,
          train_rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY, folds: int = FOLDS,
          ridge: float = RIDGE, min_docs: int = MIN_DOCS) -> Chain:
    """Chain over the 0/1 ``label_cols`` of (doc_id, text, ...), on a bounded sample.

    ``derive`` puts the derived severities of the last label before it. Copies of a text share a
    fold.
    """
    picked = bounded_sample(labelled, F.xxhash64("doc_id", "text"), train_rows).select(
        "text", F.array(*[F.col(c).cast("int") for c in label_cols]).alias("y"),
        F.pmod(F.xxhash64("text"), F.lit(folds)).alias("fold"))
    sample = checkpointed(picked)
    categories = label_cols[:-1] + (SEVERITIES if derive else []) + label_cols[-1:]
    chain = Chain(telling_features(sample, vocabulary, min_docs), categories, ridge)
    if chain.index:
        rows = arrow_map(sample, _featurizer(chain),
                         "at array<int>, x array<double>, y array<int>, fold long").toArrow()
        at, values, y, fold = (c.combine_chunks() for c in rows.columns)
        width = len(chain.index) + 2
        x, y = matrix(at, values, width + len(categories) - 1), np.array(y.to_pylist(), float)
        if derive:
            y = np.c_[y[:, :-1], severities(x[:, :width], y[:, -1]), y[:, -1]]
        chain.train_wide(x, y, fold.to_numpy())
    return chain


def _scorer(chain: Chain, text_col: str | None):
    """Score the texts of field ``text_col`` of the rows, or of the first column if None."""
    k = len(chain.categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.columns[-1]
            texts = rows.field(text_col) if text_col else batch.column(0)
            x = np.array([chain.features(b) for b in blobs(texts)]).reshape(
                batch.num_rows, len(chain.index) + 2)
            p = chain.predict(x) if chain.weights else np.zeros((batch.num_rows, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(p[:, i], pa.float64()) for i in range(k)] + [rows],
                names=[f"p_{c}" for c in chain.categories] + ["row"])

    return run


def score(docs: DataFrame, chain: Chain, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """p_<category> columns and ``row``, a struct of the ``keep`` columns (default: all)."""
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    # the text is sent once: inside the row if it is kept, beside it if not
    inside = text_col in keep
    rows = docs.select(row) if inside else docs.select(F.col(text_col).alias("text"), row)
    return arrow_map(rows, _scorer(chain, text_col if inside else None), row_schema(
        ", ".join(f"p_{c} double" for c in chain.categories), row=rows.schema["row"].dataType))


CATEGORIES = [*SEVERITIES, "toxic"]


def fit_documents(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Chain:
    """The query's chain: severities, then the label; from a bounded number of labelled ids."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = _sampled(known, train_rows).withColumnRenamed("doc_id", "known")
    # at most about train_rows rows of two numbers: bounded, so broadcast outright
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("known"))
    return train(rows.select("doc_id", "text", "toxic"), ["toxic"], derive=True,
                 train_rows=train_rows)


def digest(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scored.select("row.doc_id", *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in CATEGORIES],
                         (F.col("p_toxic") >= threshold).alias("toxic"))
