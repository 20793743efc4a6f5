"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from cinelens.llm import spelling
from cinelens.llm.common import table
from cinelens.llm.queries import QUERIES

from llm_cases import DOCS, ODD, SF001, clashing, rows_of


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def edits(w):
    """All strings that deleting one letter makes of w, and w with one letter blanked."""
    return {w[:k] + w[k + 1:] for k in range(len(w))}, {w[:k] + "*" + w[k + 1:] for k in range(len(w))}


def brute_vocabulary(rows, every=97):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def brute(vocab):
    shorter, blank = {}, {}
    for w in vocab:
        less, other = edits(w)
        for x in less:
            shorter.setdefault(x, set()).add(w)
        for x in other:
            blank.setdefault(x, set()).add(w)
    form, near_of = {}, {}
    for w, n in vocab.items():
        less, other = edits(w)
        near = set().union(*(blank[x] for x in other)) - {w} | {x for x in less if x in vocab} | shorter.get(w, set())
        near_of[w] = near
        best = min(near, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= 2 * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), vocab[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_whole_table_matches_brute_force(spark, docs01):
    from llm_cases import SF01
    got = rows_of(QUERIES["op12_spelling_variants"](spark, SF01), *COLUMNS)
    assert got == brute(brute_vocabulary(docs01.items()))
    assert sum(1 for r in got if r[2] != r[0]) > 20 and any(r[2] != r[1] for r in got if r[1])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=25, unique=True), st.integers(0, 3))
def test_index_finds_exactly_one_edit(words, head):
    index = spelling.BitSlicedIndex(words)
    for q in words:
        m = len(q)
        got = {words[k] for k in index.members(index.near(q, {m - 1, m, m + 1}))}
        assert got == {w for w in words if one_edit(q, w)}
        only = {words[k] for k in index.members(index.near(q, {m, m + 1}, head))}
        if head <= m:
            assert only == {w for w in got if len(w) >= m and w[:head] != q[:head]}


@pytest.mark.parametrize("tile", [3, 1 << 15])
def test_tiles_and_short_words(spark, tile):
    # all words are near many others, some are single letters, tiles hold three words each
    vocab = {w: 3 + (hash_ * 7) % 50 for hash_, w in enumerate(
        [a + b + c for a in ("", "a", "b", "ä") for b in ("a", "b") for c in ("", "a", "c")])}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert rows_of(spelling.variant_groups(df, tile=tile), *COLUMNS) == brute(vocab)


def test_ties_take_the_smaller_word_and_roots_go_to_the_end(spark):
    vocab = {"paper": 100, "papers": 40, "paqer": 40, "paqerz": 5, "papersy": 9, "other": 7, "otherr": 7}
    got = {r.word: r for r in spelling.variant_groups(
        spark.createDataFrame(list(vocab.items()), "word string, n long")).collect()}
    assert got["papersy"].form == "papers" and got["papersy"].root == "paper"
    assert got["paqerz"].form == "paqer" and got["paqerz"].root == "paper" and got["paqerz"].form_n == 40
    assert got["other"].form is None and got["other"].n_near == 1 and got["other"].root == "other"
    assert got["paper"].form is None and got["paper"].n_near == 2 and got["paper"].form_n is None


def test_odd_rows(spark, odd):
    rows = [(r[0], r[1]) for r in ODD] * 2 + [(20, "ÀÉÎÕÜ × ÷ àéîõü ÿÿÿÿÿ")] * 4
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    got = spelling.variant_groups(spelling.vocabulary(
        clashing(df, "word", "n", "form", "root", "kind"), rule=spelling.deletion_noise()))
    assert rows_of(got, *COLUMNS) == brute(brute_vocabulary(rows))
    assert {"x" * 100_000, "word", "ÀÉÎÕÜ"} & {r[0] for r in rows_of(got, "word")} == {"ÀÉÎÕÜ"}
    three = spark.createDataFrame([(i, "x" * 50_000, "en", "a", 1) for i in range(3)]
                                  + [(i, "x" * 49_999, "en", "a", 1) for i in range(9)], DOCS)
    assert sorted((len(r.word), r.n_near, len(r.root)) for r in spelling.variant_groups(
        spelling.vocabulary(three)).collect()) == [(49_999, 1, 49_999), (50_000, 1, 49_999)]


def test_empty_and_whole_texts(spark, none):
    assert spelling.variant_groups(spelling.vocabulary(none)).collect() == []
    docs = table(spark, SF001, "documents")
    plain = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert plain == brute_vocabulary([(r.doc_id, r.text) for r in docs.collect()], every=1 << 40)
