"""Mixing: targets and streams against brute force, reruns, schedules, odd rows."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from cinelens.llm import mixing
from cinelens.llm.queries import QUERIES
from oracle_check import compare, duck

from llm_cases import DOCS, ODD, SF01, clashing, rows_of


def brute(rows, weights=(5, 2, 1), most=3):
    """(doc_id, size, source_size, target, taken) per row."""
    sized = [(i, len(re.findall("[^\x20\x09-\x0d]+", t or "")), s) for i, t, s in rows]
    total = Counter()
    for _, n, s in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    everything, full = sum(total.values()), set()
    while True:
        rest = everything - sum(most * total[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: float(most * total[s]) if s in full else weight[s] * rest / w for s in names}
        more = {s for s in names if s not in full and target[s] > most * total[s]}
        if not more:
            break
        full |= more
    seen, records = Counter(), []
    for (i, n, s), (_, t, _) in zip(sized, rows):
        key = (i, n, s, t)
        mark = hashlib.md5(":".join(["42"] + ([] if i is None else [str(i)]) + [str(n), str(seen[key])]).encode()).hexdigest()
        seen[key] += 1
        records.append((s, mark, i, n))
    before, out = Counter(), []
    for s, mark, i, n in sorted(records, key=lambda r: (r[0] is None, r[0] or "", r[1])):
        stop = int(target[s] + 0.5)
        taken = sum(max(0, min(n, stop - before[s] - p * total[s])) for p in range(most))
        before[s] += n
        out.append((i, n, total[s], target[s], taken))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def test_whole_table_matches_sql_and_brute_force(spark):
    res = compare(spark, duck(SF01), "op13_mixing", SF01)
    assert res["cols_ok"] and res["rows_ok"] and res["values_ok"], res
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = rows_of(QUERIES["op13_mixing"](spark, SF01), *COLUMNS)
    assert got == brute([(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_targets_are_met_to_the_word(spark):
    out = QUERIES["op13_mixing"](spark, SF01)
    assert out.where("taken > 3 * size").count() == 0
    by = out.groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 1 for r in by) and any(r.t == 3 * r.source_size for r in by)


def test_reruns_and_partitionings_agree(spark):
    docs = spark.createDataFrame([(k % 40, "word " * (k % 9), "en", "ab"[k % 2], 1) for k in range(200)], DOCS)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    one, two = (rows_of(mixing.digest(mixing.mix(d))) for d in (docs.repartition(1), docs.repartition(7, "text")))
    assert one == two
    assert rows_of(mixing.digest(mixing.mix(docs)), *COLUMNS) == brute(rows)


def test_one_row_repeated_beyond_a_chunk(spark):
    n = 2 * mixing.CHUNK + 5
    docs = spark.range(n).select(F.lit(1).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(2, "x " * 5000, "b"), (3, "y", None)], "doc_id long, text string, source string"))
    out = rows_of(mixing.digest(mixing.mix(docs)), *COLUMNS)
    assert len(out) == n + 2 and out == brute([(r.doc_id, r.text, r.source) for r in docs.collect()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0, 9), min_size=2, max_size=5).filter(lambda w: sum(w) > 0.1), st.floats(0, 1))
def test_times_invert_the_integral(weights, share):
    s = mixing.Schedule(tuple((k / (len(weights) - 1), w) for k, w in enumerate(weights)))
    at = _time(s, share)
    sums, due, got = s.integrals(), share * s.integrals()[-1], 0.0
    for (t0, w0), (t1, w1) in zip(s.knots, s.knots[1:]):
        x = min(max(at - t0, 0.0), t1 - t0)
        got += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
    assert 0 <= at <= 1 and abs(got - due) < 1e-6 * max(1.0, sums[-1])


def _time(schedule, share):
    from pyspark.sql import SparkSession
    from cinelens.session import get_session
    spark = SparkSession.getActiveSession() or get_session(master="local[*]", app="cinelens-tests", shuffle_partitions=8)
    return spark.range(1).select(schedule.time_of(F.lit(float(share))).alias("t")).first().t


def test_curriculum_order(spark):
    # a fading and a growing source of the same size: the first comes early, the second late
    up, down = mixing.Schedule(((0.0, 0.0), (1.0, 2.0))), mixing.Schedule(((0.0, 2.0), (1.0, 0.0)))
    docs = spark.createDataFrame([(k, "w " * 10, "en", "ab"[k % 2], 1) for k in range(400)], DOCS)
    order = mixing.mix(docs, (down, up)).where("words > 0").orderBy("first_word").collect()
    assert [r.first_word for r in order] == list(range(0, 4000, 10))  # no gap in the training order
    assert [r.time for r in order] == sorted(r.time for r in order)
    half = Counter(r.source for r in order if r.time < 0.5)
    assert half["a"] == 150 and 50 <= half["b"] <= 51  # 3/4 and 1/4 of the integrals
    texts = mixing.in_order(clashing(docs, "words", "row", "r_id"), mixing.mix(docs, (down, up))).collect()
    assert [(r.first_word, r.row.doc_id) for r in texts] == [(r.first_word, r.doc_id) for r in order]


@pytest.mark.parametrize("knots", [((0.0, 1.0),), ((0.1, 1.0), (1.0, 1.0)), ((0.0, -1.0), (1.0, 1.0)), ((0.0, 0.0), (1.0, 0.0))])
def test_bad_schedules(knots):
    with pytest.raises(ValueError):
        mixing.Schedule(knots)


def test_odd_rows_and_empty_tables(spark, odd, none):
    rows = [(r[0], r[1], r[3]) for r in ODD]
    got = mixing.digest(mixing.mix(clashing(odd, "size", "copies", "target", "mark", "prefix")))
    assert rows_of(got, *COLUMNS) == brute(rows)
    assert mixing.digest(mixing.mix(none)).collect() == []
    blank = odd.where("doc_id IN (1, 2, 3, 10)")
    assert rows_of(mixing.digest(mixing.mix(blank)), *COLUMNS, "first_word") == [
        (i, 0, 0, 0.0, 0, None) for i in (1, 10, 2, 3)]
