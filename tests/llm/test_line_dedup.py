"""Operator 2 against brute force and its SQL."""

import hashlib
import random

import duckdb
import numpy as np

from cinelens.llm import line_dedup
from cinelens.llm.queries import ORACLE_SQL, op2_line_dedup

from llm_cases import ODD, SF01, clashing, rows_of

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows):
    """(doc_id, n_lines, n_dropped, sha) per (doc_id, text); a null id sorts last."""
    order = lambda i: (i is None, i or 0)
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10 and (k not in owner or order(i) < order(owner[k])):
                owner[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    cur = con.execute(ORACLE_SQL["op2_line_dedup"])
    df = op2_line_dedup(spark, SF01)
    assert [d[0] for d in cur.description] == df.columns
    assert rows_of(df) == sorted(map(tuple, cur.fetchall()), key=repr)


def test_odd_rows(spark, odd):
    got = rows_of(line_dedup.digest(clashing(odd, "row", "keep", "pos", "n_lines", "part")))
    assert got == brute([(i, t) for i, t, *_ in ODD])


def test_hot_line_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["A Very common line ", "a very common line", f"line number {i % 7} here",
                                     f"own line of {i}", "short"]) for _ in range(6))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert rows_of(line_dedup.digest(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_hash_that_fills_whole_partitions():
    # partition -> first hash, document of its first record; last hash, document of its first record
    edges = [(0, 1, 1, False, 5, 2, 2, False, 7), (1, 2, 2, False, 9, 2, 2, False, 9),
             (3, 2, 2, False, 11, 4, 4, False, 3), (4, 5, 5, False, 1, 5, 5, False, 1)]
    assert line_dedup.owners_at_start(edges) == {1: (2, 2, False, 7), 3: (2, 2, False, 7)}


def test_bitmaps_round_trip():
    for drop in ([0], [7], [8], [0, 3, 9, 1000], list(range(50))):
        bits = line_dedup.unpack(line_dedup.pack(drop))
        assert list(np.flatnonzero(~bits)) == drop and len(bits) == max(drop) + 1


def test_texts_and_columns_survive(spark):
    df = spark.createDataFrame([(2, "first shared line\nown words of two", "en"), (1, "First Shared Line ", "de"),
                                (3, None, "fr")], "doc_id long, text string, lang string")
    out = line_dedup.keep_lines(df, line_dedup.keep_bitmaps(df))
    got = {r.row.doc_id: (r.text, r.row.lang, r.n_dropped) for r in out.collect()}
    assert got == {1: ("First Shared Line ", "de", 0), 2: ("own words of two", "en", 1), 3: (None, "fr", 0)}


def test_empty_table(none):
    assert line_dedup.digest(none).collect() == []


def test_one_row_repeated_for_a_third_of_the_table(spark):
    hot = (7, "a line that many hold\nown line of the hot row\nA line that many hold ")
    rows = [hot] * 3000 + [(i, f"a line that many hold\nline of {i} alone") for i in range(3000)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    # one record per line of the row, not one per copy
    assert line_dedup.line_records(df, "doc_id", "text", 10).where("doc = 7").count() == 5
    assert rows_of(line_dedup.digest(df)) == brute(rows)
