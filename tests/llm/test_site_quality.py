"""Operator 7: shrinkage against brute force, held-out accuracy, odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelens.llm import site_quality as sq
from cinelens.llm.queries import op7_quality_classifier

from llm_cases import ODD, SF01, clashing

SF1 = "/root/testdata/sf0.1"


def run(docs, labels, **kw):
    return sq.classify(docs, labels, F.col("source"), F.col("lang"), **kw)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")
    held = F.pmod(F.xxhash64(F.lit(78), "doc_id"), F.lit(4)) == 0
    m = run(docs, labels.where(~held)).join(labels.where(held), "doc_id").toPandas()
    assert m[m.quality == 1].kept.mean() > 0.97 and m[m.quality == 0].kept.mean() < 0.35  # noisy labels


def test_query_covers_every_document(spark, docs01):
    rows = op7_quality_classifier(spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs01)


def brute_strength(sites, mean, at):
    """``sites``: (n, s, centre)."""
    k, n = len(sites), sum(x[0] for x in sites)
    if k < 2:
        return 1e4
    typical = (n - sum(x[0] ** 2 for x in sites) / n) / (k - 1)
    spread = mean * (1 - mean)
    if typical <= 1 or spread <= 0:
        return 1e4
    share = (sum(x[0] * (x[1] / x[0] - x[2]) ** 2 for x in sites) / (k - 1) - spread) / ((typical - 1) * spread)
    return min(1e4, max(1.0, 1 / share - 1)) if share > 0 else 1e4


def test_posteriors_match_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for h in range(30):
        good = rng.beta(2, 2)
        for p in range(rng.integers(1, 5)):
            for _ in range(int(rng.integers(1, 40))):
                rows.append((None if h == 0 else f"h{h}", f"p{p}", float(rng.random() < good) * .9 + .05))
    df = spark.createDataFrame(rows, "host string, path string, p double")
    sites, strength, mean = sq.site_posteriors(df)
    want_mean = sum(r[2] for r in rows) / len(rows)
    assert mean == pytest.approx(want_mean)
    hosts, paths = {}, {}
    for h, p, x in rows:
        for d, k in ((hosts, h), (paths, (h, p))):
            n, s = d.get(k, (0, 0.0))
            d[k] = (n + 1, s + x)
    kh = brute_strength([(n, s, want_mean) for n, s in hosts.values()], want_mean, 0)
    host_mean = {h: (s + kh * want_mean) / (n + kh) for h, (n, s) in hosts.items()}
    kp = brute_strength([(n, s, host_mean[h]) for (h, _), (n, s) in paths.items()], want_mean, 0)
    assert strength == pytest.approx(kp)
    got = {(r.host, r.path): r.host_mean for r in sites.collect()}
    assert set(got) == set(paths) and all(got[k] == pytest.approx(host_mean[k[0]]) for k in got)


def test_sparse_sites_shrink_and_rich_ones_move(spark):
    good, bad = "Plain words, in lines. " * 10, "### $$$ *** ||| " * 20
    rows, labels = [], []
    for i in range(600):
        junk = i % 2
        host = ("junk" if junk else "fine") if i < 500 else f"site{i}"
        rows.append((i, bad if junk else good, "en", host, 1))
        labels.append((i, 1 - junk, 0))
    middle = "Plain words, in lines. ### $$$ " * 10
    rows += [(1000, middle, "en", "junk", 1), (1001, middle, "en", "fine", 1), (1002, middle, "en", "new", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in run(docs, labels).collect()}
    assert got[1000].p_document == got[1001].p_document == got[1002].p_document
    assert got[1000].p_quality < got[1002].p_quality < got[1001].p_quality
    assert got[1000].p_host < got[1002].p_host < got[1001].p_host
    assert got[0].kept and not got[1].kept


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    rows = run(clashing(odd, "p", "host", "path", "kept"), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.p_quality <= 1 for r in rows)


def test_without_labels_all_is_kept(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = run(odd, labels).collect()
    assert len(rows) == len(ODD) and all(r.kept and r.p_document == 0.5 for r in rows)
    assert run(none, labels).collect() == []


def test_statistics_of_nothing():
    assert len(sq.statistics(b"")) == len(sq.STATS) and not any(map(math.isnan, sq.statistics(b"")))
