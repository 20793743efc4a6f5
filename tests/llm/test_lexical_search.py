"""Ranked lexical search against brute force over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from cinelens.llm import lexical_search as ls
from cinelens.llm.common import table
from cinelens.llm.queries import QUERIES

from llm_cases import DOCS, ODD, SF01, clashing

ITEMS = "item_id string, text string"


def terms(text):
    found = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]


def brute(rows, items, k=10):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in rows) if t]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked if df[t]}
        scored = []
        for i, c, n in docs:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(q * w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in asked.items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


def test_whole_tables_match_brute_force(spark, docs01):
    b = pq.read_table(f"{SF01}/benchmark.parquet")
    items = list(zip(b["item_id"].to_pylist(), b["text"].to_pylist()))
    got = found(QUERIES["op11_lexical_search"](spark, SF01))
    assert got == brute(docs01.items(), items) and len(got) == 10 * len(items)


@pytest.mark.parametrize("k, postings, slice_bytes", [(1, 50, 1 << 20), (3, 7, 40), (10, 1 << 20, 1 << 20)])
def test_blocks_slices_and_ties(spark, k, postings, slice_bytes):
    rng = np.random.default_rng(k)
    words = [f"w{int(x)}" for x in rng.zipf(1.4, 40)] + ["É", "é", "A1b"]
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(0, 30)))) for i in rng.permutation(300)]
    rows += [(1000 + i, "w1 w2, W2! é same text") for i in range(40)] + [(None, "w1 w2 same text")] * 3 + [(7, "w1 same")] * 2
    items = [("a", "W1 w2 w2 é same"), ("a", "W1 w2 w2 é same"), ("b", "same"), ("c", None), ("d", " ,.; "), (None, "w1"),
             ("e", "not there"), ("f", "not there w3 w4 w1 text")] + [(f"r{i}", " ".join(rng.choice(words, 8))) for i in range(20)]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).repartition(5)
    got = ls.search(ls.build_index(df), spark.createDataFrame(items, ITEMS), k, slice_bytes=slice_bytes,
                    block_postings=postings)
    assert found(got) == brute(rows, items, k)


def test_pruning_leaves_entries_unscored():
    # a strong document first: intervals whose bound is below its score are never opened
    entries = [(50, np.array([0, 1], np.int32), np.array([9, 9], np.int32))] + [
        (50, np.array([k % 2], np.int32), np.array([1], np.int32)) for k in range(1000)]
    block = ls.PostingBlock(entries, [[i] for i in range(1001)], np.array([1000, 1000]), (1001, 50_050))
    seen = []

    class Spy(ls.TopK):
        def offer(self, score, ids):
            seen.append(ids)
            super().offer(score, ids)

    top = Spy(1)
    block.search(np.array([0, 1]), np.array([1, 1]), top)
    assert [r[2] for r in top.rows] == [0] and len(seen) == 1


def test_rmq_equals_the_maximum():
    rng = np.random.default_rng(5)
    entries = [(10, np.array([0], np.int32), np.array([int(t)], np.int32)) for t in rng.integers(1, 50, 97)]
    block = ls.PostingBlock(entries, [[i] for i in range(97)], np.array([7]), (97, 970))
    a = rng.integers(0, 97, 500)
    b = a + 1 + rng.integers(0, 97, 500) % (97 - a)
    assert all(block.score[p] == block.score[x:y].max() and x <= p < y for p, x, y in zip(block.largest(a, b), a, b))


def test_odd_rows_and_empty_tables(spark, odd, none):
    rows = [(r[0], r[1]) for r in ODD]
    items = [("q1", "no id here at all, only words"), ("q2", "NBSP sep ünï"), ("q3", "word x" * 3), ("q4", "")]
    asked = clashing(spark.createDataFrame(items, ITEMS), "doc_id", "score", "rank", "key")
    index = ls.build_index(clashing(odd, "n", "terms", "item_id", "query"))
    assert found(ls.search(index, asked)) == brute(rows, items)
    assert found(ls.search(index, asked.limit(0))) == []
    assert found(ls.search(ls.build_index(none), asked)) == []
    assert found(ls.search(ls.build_index(odd.where("doc_id IN (1, 2, 3, 10)")), asked)) == []


def test_index_holds_every_document_and_term(spark, docs01):
    index = ls.build_index(table(spark, SF01, "documents"))
    got = {r.doc_id: (r.n, sum(r.tfs), len(r.terms)) for r in index.collect()}
    assert got == {i: (len(t), len(t), len(set(t))) for i, t in ((i, terms(x)) for i, x in docs01.items())}
