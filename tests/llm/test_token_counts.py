"""Operator 9 against the tokenizer itself."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinelens.llm import token_counts as tc
from cinelens.llm.queries import op9_token_counts, tokenizer_path

from llm_cases import ODD, SF01, clashing, rows_of

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def count(tok, text):
    return len(tok.encode(text or "", add_special_tokens=False).ids)


def test_query_matches_tokenizer(spark, docs01, tok):
    assert rows_of(op9_token_counts(spark, SF01)) == sorted(
        [(i, len(t.encode()), n := count(tok, t), n > 1024) for i, t in docs01.items()], key=repr)


def test_odd_rows(spark, odd, tok):
    got = rows_of(tc.token_counts(clashing(odd, "n_tokens", "piece"), PATH, table_size=50))
    assert got == sorted([(i, len((t or "").encode()), count(tok, t)) for i, t, *_ in ODD], key=repr)


def test_empty_table(none):
    assert tc.token_counts(none, PATH).collect() == []


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.text(max_size=60) | st.text(alphabet="ab '\n\t .!sdrelmv1é", max_size=60))
def test_counts_do_not_depend_on_the_tiers(tok, text):
    own = tc.lengths(PATH)
    want = count(tok, text)
    assert own.count(text, {}) == want == own.count(text, own.cache) == own.count(text, {}, cache_size=0)


def test_special_strings_count_as_the_tokenizer_counts_them(tok):
    for text in ("<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext", "x<|endoftext|>'s"):
        assert tc.lengths(PATH).count(text, {}) == count(tok, text)


def test_other_tokenizers_go_whole(tok):
    path = tokenizer_path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    for text in ("Hello  World", "", "é 😀 it's"):
        assert tc.lengths(path).count(text, {}) == count(other, text)


def test_table_stays_within_its_bounds(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    table = tc.frequent_lengths(docs, PATH, "text", table_size=100, longest=8)
    assert 0 < len(table) <= 100 and max(len(p.encode()) for p in table) <= 8


def test_table_holds_what_is_frequent_in_all_documents(spark):
    rows = [(i, " hot" * 50 + " rare" + "".join(chr(97 + int(c)) for c in str(i)) + " " + "x" * 100) for i in range(300)] + [(1000 + i, " cold" * 3) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    table = tc.frequent_lengths(docs, PATH, "text", 4, 64)
    assert " hot" in table and " cold" in table and len(table) <= 4
    assert not any(p.startswith(" rare") or len(p) > 64 for p in table)
    assert tc.frequent_lengths(docs, PATH, "text", 1, 64).keys() <= {" hot"}
    assert tc.frequent_lengths(docs.limit(0), PATH, "text", 4, 64) == {}


def test_bounded_summaries_keep_the_frequent(spark):
    # far more different pre-tokens in a task than it may hold
    rows = [(i, " often" * 3 + "".join(f" w{i}x{k}" for k in range(40))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert " often" in tc.frequent_lengths(docs, PATH, "text", 20, 64)
