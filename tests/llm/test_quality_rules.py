"""Operator 5: base statistics by brute force, estimates against numpy, verdicts on labelled data."""

import re
from collections import Counter

import numpy as np
import pytest

from cinelens.llm import quality_rules as q
from cinelens.llm.queries import op5_quality_rules

from llm_cases import ODD, SF01, clashing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if seen[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.fixture(scope="module")
def judged(spark):
    return op5_quality_rules(spark, SF01).toPandas()


def test_query_matches_brute_force(judged, docs01):
    got = {r.doc_id: tuple(getattr(r, c) for c in COLS) for r in judged.itertuples()}
    assert got == {i: brute(t) for i, t in docs01.items()}


def test_verdicts_on_labelled_documents(spark, judged):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    m = judged[~judged.base_failed].merge(labels, on="doc_id")
    assert m[m.quality == 1].kept.mean() > 0.99
    assert m[m.quality == 0].kept.mean() < 0.1
    assert not judged[judged.base_failed].kept.any()


def test_odd_rows(spark, odd):
    got = sorted(((r.doc_id, *(r[c] for c in COLS))
                  for r in q.judge(clashing(odd, "kept", "grp", "n_words", "_w", "distance")).collect()), key=repr)
    assert got == sorted([(i, *brute(t)) for i, t, *_ in ODD], key=repr)


def test_repeats_that_overlap(spark):
    texts = ["a a a a", "a b a b a b", "a b c x a b c", "a b c a b", "a b c", "a b", "x a b c d y a b c d z"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in q.judge(df).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_empty_table(none):
    assert q.judge(none).collect() == []


def test_native_plan(spark):
    plan = op5_quality_rules(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_chi_square():
    assert abs(q.chi2_quantile(0.05, 5) - 11.0705) < 1e-3
    assert abs(q.chi2_quantile(1e-6, 5) - 37.33) < 0.1 or q.chi2_quantile(1e-6, 5) > 30
    assert abs(q.chi2_upper(3.0, 2) - np.exp(-1.5)) < 1e-12
    assert 1 < q.consistency(0.75, 5) < 3


def test_estimate_ignores_a_cluster_of_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([5, 1.6, 1, 1, 1], np.diag([1, .04, .25, .25, .25]) + .05, 3000)
    bad = rng.normal([9, 3, 6, 6, 6], .1, (700, 5))
    rows = [("g", *map(float, r)) for r in np.r_[good, bad]]
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{c} double" for c in q.NAMES))
    e = q.mcd(df).first()["e0"]
    assert np.abs(np.array([e[f"m{i}"] for i in range(5)]) - good.mean(axis=0)).max() < .15
    low = np.array([[e[f"l{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
    z = np.linalg.solve(low, (np.r_[good, bad] - [e[f"m{i}"] for i in range(5)]).T)
    d = (z ** 2).sum(axis=0)
    assert (d[:3000] > q.chi2_quantile(1e-4, 5)).mean() < .01 and (d[3000:] > q.chi2_quantile(1e-6, 5)).all()


def rejected(e, rows):
    low = np.array([[e[f"l{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
    z = np.linalg.solve(low, (rows - [e[f"m{i}"] for i in range(5)]).T)
    return ((z ** 2).sum(axis=0) > q.chi2_quantile(q.TAIL, 5)).mean()


def test_clusters_and_copies_up_to_nearly_half(spark):
    rng = np.random.default_rng(5)
    cases = {}
    for percent in (30, 45):
        n = 40 * percent
        good = rng.multivariate_normal([5, 1.6, 1, 1, 1], np.diag([1, .04, .25, .25, .25]) + .05, 4000 - n)
        cases[f"wide {percent}"] = good, rng.normal([9, 3, 6, 6, 6], .5, (n, 5))
        cases[f"tight {percent}"] = good, rng.normal([9, 3, 6, 6, 6], .01, (n, 5))
        cases[f"one side {percent}"] = good, rng.normal([5, 1.6, 1, 12, 1], .1, (n, 5))
        cases[f"clean near copies {percent}"] = good, rng.normal([5.5, 1.6, 1, 1.3, 1], .01, (n, 5))
        cases[f"far copies {percent}"] = good, np.repeat([[9., 3., 6., 6., 6.]], n, axis=0)
    for percent in (30, 45, 50, 60, 70):
        good = rng.multivariate_normal([5, 1.6, 1, 1, 1], np.diag([1, .04, .25, .25, .25]) + .05, 4000 - 40 * percent)
        cases[f"clean copies {percent}"] = good, np.repeat(good[:1], 40 * percent, axis=0)
    rows = [(name, *map(float, r)) for name, parts in cases.items() for r in np.r_[parts]]
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{c} double" for c in q.NAMES))
    estimates = {r.grp: r.e0 for r in q.mcd(df).collect()}
    got = {name: (rejected(estimates[name], good), rejected(estimates[name], rest))
           for name, (good, rest) in cases.items()}
    wrong = {k: v for k, v in got.items() if v[0] > .01 or v[1] != (0 if "clean" in k else 1)}
    assert not wrong


def test_copies_are_judged_each(spark):
    rng = np.random.default_rng(7)
    words = np.array(["alpha", "be", "gamma", "delta", "of", "epsilon", "to", "zeta"])
    texts = [" ".join(rng.choice(words, int(n)) + rng.integers(0, 99, int(n)).astype(str))
             for n in rng.integers(80, 300, 200)]
    texts += [texts[0]] * 400 + ["# $ % & | < > * " * 5 + "".join(f"& w{i} " for i in range(90))] * 150
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in q.judge(df).collect()}
    assert len(kept) == 750 and all(kept[i] for i in range(600)) and not any(kept[i] for i in range(600, 750))
