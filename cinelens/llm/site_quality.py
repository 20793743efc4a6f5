"""Operator 7: quality classifier with hierarchical empirical Bayes over sites.

1. A document classifier (logistic regression over binned text statistics,
   fitted on at most about ``train_rows`` labelled rows) gives every document
   a probability of being good.
2. Hosts and paths sum these probabilities (map-side combined, so a host with
   a third of all documents arrives as one row per task). The global mean and
   the spread between hosts set a Beta prior; a host's posterior is its mean
   shrunk towards the global one, a path's posterior its mean shrunk towards
   its host's, the more the fewer documents it has. Prior strengths are moment
   estimates over all hosts and all paths.
3. The verdict adds the path's log-odds against the global ones to the
   document's, with the document's own share taken out of its path first.

Site tables grow with the number of sites and are joined by size, never hinted.

Cases: a null text has no words (its statistics are zero); null host or path
are sites of their own; with no labelled rows all documents get probability
0.5 and are kept; documents without label are scored like any other; repeated
rows count as often as they occur; an empty table gives an empty result; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.llm import logistic
from cinelens.llm.common import arrow_map, blobs, bounded_sample, checkpointed, record_batch, row_schema

TRAIN_ROWS, RIDGE, THRESHOLD = 20_000, 1.0, 0.3
#: Bin edges of each statistic, as quantiles of the sample; dense at the ends, where junk lies.
QUANTILES = (0.005, 0.01, 0.02, 0.05, 0.08, 0.12, 0.18, 0.3, 0.5, 0.7, 0.8, 0.84, 0.88, 0.91, 0.94, 0.97, 0.985, 0.995)
STATS = ("n_words", "word_length", "symbols", "capitals", "digits", "same_words", "same_lines",
         "line_words", "stops", "bars", "longest")


def statistics(data: bytes) -> list[float]:
    """Plain statistics of a text, in the order of ``STATS``."""
    words = data.split()
    n = max(1, len(words))
    chars = max(1, len(data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    plain = len(data.translate(None, b"#*$%&|<>!{}[]=_~^"))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    return [np.log1p(len(words)), sum(map(len, words)) / n, (len(data) - plain) / n, upper / chars,
            digits / chars, 1 - len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines))), (data.count(b".") + data.count(b",")) / n,
            data.count(b"|") / n, max(map(len, words), default=0) / 100]


class QualityModel:
    """Logistic regression over one-hot quantile bins of the statistics."""

    def __init__(self, x: np.ndarray, y: np.ndarray, quantiles=QUANTILES, ridge: float = RIDGE):
        self.edges = [np.unique(np.quantile(x[:, i], quantiles)) for i in range(x.shape[1])]
        self.weights = logistic.fit(self.binned(x), y, ridge)

    def binned(self, x: np.ndarray) -> np.ndarray:
        hot = []
        for i, e in enumerate(self.edges):
            bins = np.searchsorted(e, x[:, i], side="right")
            hot.append(np.eye(len(e) + 1)[bins])
        return np.concatenate(hot, axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return logistic.predict(self.binned(x), self.weights)


def _stats_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("x", pa.list_(pa.float64())), ("y", pa.float64())])
    for batch in batches:
        yield record_batch(schema, [[statistics(b) for b in blobs(batch.column(0))], batch.column(1)])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> QualityModel | None:
    """Document classifier from a bounded sample of labelled rows, each id and text once; None without both classes."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("known")).agg(
        F.max(label_col).cast("double").alias("y"))
    n = known.count()
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(7), "known"), F.lit(1 << 20))
                            < int((1 << 20) * train_rows / n))
    # at most about train_rows rows of two numbers: bounded, so broadcast outright
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(known), F.col("id") == F.col("known")).select("id", "text", "y")
    # one row per id and text, and the bound holds for rows too: an id may be on any number of them
    rows = bounded_sample(rows, F.xxhash64("id", "text"), train_rows).select("text", "y")
    got = arrow_map(rows, _stats_rows, "x array<double>, y double").toPandas()
    if got["y"].nunique() < 2:
        return None
    return QualityModel(np.array(got["x"].tolist()), got["y"].to_numpy())


def _scorer(m: QualityModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(b) for b in blobs(batch.column(0))]).reshape(-1, len(STATS))
            p = m.predict(x) if m and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.float64()), *batch.columns[1:]],
                                             names=["p", *batch.schema.names[1:]])

    return run


def _strength(sums: DataFrame, mean: float) -> float:
    """Moment estimate of a Beta prior's strength from (n, s) of sites."""
    got = sums.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                   F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m"), F.lit(2.0))).alias("d")).first()
    if not got["k"] or got["k"] < 2:
        return 1e4
    spread = mean * (1 - mean)
    typical = (got["n"] - got["nn"] / got["n"]) / (got["k"] - 1)
    if typical <= 1 or spread <= 0:
        return 1e4
    share = (got["d"] / (got["k"] - 1) - spread) / ((typical - 1) * spread)
    return float(min(1e4, max(1.0, 1 / share - 1))) if share > 0 else 1e4


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """((host, path, n, s, host_mean) per path, path prior strength, global mean) from (p, host, path)."""
    paths = checkpointed(scored.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"),
                                                           F.sum("p").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = (total[1] / total[0]) if total[0] else 0.5
    of_hosts = _strength(hosts.withColumn("m", F.lit(mean)), mean)
    shrunk = hosts.select(F.col("host").alias("h"), ((F.col("s") + of_hosts * mean) / (F.col("n") + of_hosts))
                          .alias("host_mean"))
    joined = paths.join(shrunk, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    of_paths = _strength(joined.withColumn("m", F.col("host_mean")), mean)
    return joined, of_paths, mean


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, host, path, p_document, p_host, p_path, p_quality, kept) per row."""
    m = train(docs, labels, id_col, text_col, label_col, train_rows)
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"),
                       host.cast("string").alias("host"), path.cast("string").alias("path"))
    scored = checkpointed(arrow_map(rows, _scorer(m), row_schema(
        "p double", doc_id=rows.schema["doc_id"].dataType, host=T.StringType(), path=T.StringType())))
    sites, strength, mean = site_posteriors(scored)
    right = sites.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "host_mean")
    both = scored.join(right, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")), "left")
    rest = (F.col("s") - F.col("p") + strength * F.col("host_mean")) / (F.col("n") - 1 + strength)
    score = _logit(F.col("p")) + _logit(rest) - _logit(F.lit(mean))
    quality = 1 / (1 + F.exp(-score))
    return both.select("doc_id", "host", "path", F.col("p").alias("p_document"),
                       F.col("host_mean").alias("p_host"),
                       ((F.col("s") + strength * F.col("host_mean")) / (F.col("n") + strength)).alias("p_path"),
                       quality.alias("p_quality"), (quality >= threshold).alias("kept"))


def digest(rows: DataFrame) -> DataFrame:
    probs = ("p_document", "p_host", "p_path", "p_quality")
    return rows.select("doc_id", *[F.round(c, 6).alias(c) for c in probs], "kept")
