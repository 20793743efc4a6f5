"""Operator 10 against brute force over windows."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pyarrow.parquet as pq

import pytest

from cinelens.llm import decontamination as dc
from cinelens.llm.queries import ORACLE_SQL, op10_decontamination

from llm_cases import ODD, SF01, clashing, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[i:i + 10])].add(item)
    sizes = {len(k) for k in wins}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if tuple(w[at:at + n]) in wins:
                    hit |= set(range(at, at + n))
                    found |= wins[tuple(w[at:at + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in df.collect()], key=repr)


def test_query_matches_brute_force(spark, docs01):
    b = pq.read_table(f"{SF01}/benchmark.parquet")
    items = list(zip(b["item_id"].to_pylist(), b["text"].to_pylist()))
    want = brute(docs01.items(), items)
    assert got(op10_decontamination(spark, SF01)) == want and any(r[5] for r in want)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL["op10_decontamination"])
    df = op10_decontamination(spark, SF01)
    assert [d[0] for d in cur.description] == df.columns
    assert rows_of(df) == sorted(map(tuple, cur.fetchall()), key=repr)


ITEMS = [(1, "One two THREE four, five six seven eight nine ten"), (2, "nine ten"), (2, "漢字"), (3, None), (4, "--"),
         (5, "word " * 12), (None, "another text"), (10, "ÜNÏ çödé"), (6, "same id eight nine ten")]


def test_odd_rows_and_slices(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute([(i, t) for i, t, *_ in ODD], ITEMS)
    docs = clashing(odd, "items", "n_words", "row_key", "hit_words")
    assert got(dc.digest(dc.scan_benchmark(docs, bench))) == want
    # a benchmark beyond the bound is cut into slices: same result
    assert got(dc.digest(dc.scan_benchmark(docs, bench, slice_bytes=150))) == want


def test_empty_tables(spark, none, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.digest(dc.scan_benchmark(none, bench)).collect() == []
    rows = dc.digest(dc.scan_benchmark(odd, bench.limit(0))).collect()
    assert len(rows) == len(ODD) and not any(r.contaminated for r in rows)


def test_spans_point_at_the_original(spark):
    text = "é😀 start: One  two—three, FOUR five six seven eight nine ten eleven end"
    bench = spark.createDataFrame([(1, "three four five six seven eight nine ten eleven end")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, text.replace("—", "-"))], "doc_id long, text string")
    r = dc.scan_benchmark(docs, bench).first()
    a, b = map(int, r.spans.split(":"))
    assert text.replace("—", "-")[a:b] == "three, FOUR five six seven eight nine ten eleven end"
    assert r.hit_words == list(range(4, 14))


def test_clean_documents_keep_their_columns(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = [r[0] for r in brute([(i, t) for i, t, *_ in ODD], ITEMS) if not r[5]]
    for size in (dc.SLICE_BYTES, 150):
        out = dc.clean_documents(odd, bench, slice_bytes=size)
        assert out.schema == odd.schema
        assert sorted([r.doc_id for r in out.collect()], key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("slice_bytes", [8 << 20, 64])
def test_clean_documents_keep_any_column(spark, odd, slice_bytes):
    names = ("__key", "__hit_id", "__hit_key", "row", "items")
    df = clashing(odd, *names)
    items = spark.createDataFrame([("q", "one two three four five six seven eight nine ten eleven"), ("r", "no such item here")],
                                  "item_id string, text string")
    out = dc.clean_documents(df, items, slice_bytes=slice_bytes)
    assert out.columns == df.columns and all(r[n] == f"own {n}" for r in out.collect() for n in names)
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(
        (i or 0) for i, t, *_ in ODD if not (t or "").lower().startswith("one two three"))
