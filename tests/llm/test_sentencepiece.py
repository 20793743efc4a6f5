"""Operator 4 against the library, on whole tables and random texts."""

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cinelens.llm import sentencepiece_stream as sps
from cinelens.llm.queries import op4_sentencepiece, tokenizer_path

from llm_cases import ODD, SF01, clashing

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sps.Model(PATH)


def test_query_matches_library(spark, docs01, lib):
    rows = op4_sentencepiece(spark, SF01).collect()
    assert len(rows) == len(docs01)
    for r in rows:
        assert r.ids == lib.encode(docs01[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_odd_rows(spark, odd, lib):
    out = sps.encode_documents(clashing(odd, "ids", "n_tokens"), PATH)
    got = sorted(((r.row.doc_id, r.ids) for r in out.collect()), key=repr)
    assert got == sorted([(i, lib.encode(t or "")) for i, t, *_ in ODD], key=repr)
    back = sps.decode_documents(out, PATH)
    assert sorted(((r.row.doc_id, r.text) for r in back.collect()), key=repr) == sorted(
        [(i, lib.decode(lib.encode(t or ""))) for i, t, *_ in ODD], key=repr)


def test_empty_table(none):
    assert sps.encode_documents(none, PATH).collect() == []


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.text(max_size=60) | st.text(alphabet="aeinrst t▁ \n", max_size=200)
       | st.text(alphabet="the of and ing", max_size=120))
def test_random_texts(lib, model, text):
    text = text.replace("\x00", "")
    ids = model.encode(text)
    assert ids.tolist() == lib.encode(text)
    assert model.decode(ids) == lib.decode(ids.tolist())


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.text(alphabet="aeinrstlohd", min_size=80, max_size=600), st.integers(1, 40))
def test_streaming_commits_the_same_pieces(model, text, every):
    whole = model.merge("▁" + text)
    assert model.segment("▁" + text, check_every=every) == whole


def test_the_window_stays_bounded(model):
    seen, text = [], "▁" + "internationalisation" * 2000
    meeting = model._meeting

    def spy(last, at, done):
        seen.append(len(last))
        return meeting(last, at, done)

    model._meeting = spy
    try:
        pieces = model.segment(text)
    finally:
        del model._meeting
    assert "".join(pieces) == text and max(seen) < 400


def test_runs_of_blanks(lib, model):
    for n in list(range(1, 70)) + [1000]:
        for text in (" " * n, "a" + " " * n + "b", "a" + " " * n):
            assert model.encode(text).tolist() == lib.encode(text), n


def test_decode_of_no_ids(model):
    assert model.decode(np.empty(0, np.int32)) == ""


class Counting(dict):
    """Counts what is looked up."""

    looked = 0

    def get(self, *key):
        self.looked += 1
        return super().get(*key)


def test_a_merge_scores_each_neighbour_once(model):
    text, score = "▁" + "internationalisation" * 20, model.score
    model.score = Counting(score)
    try:
        parts = model.merge(text)
        looked = model.score.looked
    finally:
        model.score = score
    assert "".join(parts) == text and looked < 3 * len(text)


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.text(alphabet="aeinrst▁ hd😀漢\x00", min_size=1, max_size=80), st.integers(0, 79), st.integers(1, 80))
def test_edges_are_whole_pieces_and_single_characters(model, text, start, more):
    start = min(start, len(text) - 1)
    stop = min(start + more, len(text))
    edges = [(e + 1, code, k) for e, (code, k) in model._edges(text, start, stop) if e >= start]
    assert edges == [(j, model.ids.get(text[i:j], model.size + ord(text[j - 1])), j - i)
                     for j in range(start + 1, stop + 1) for i in range(max(0, j - model.longest), j)
                     if text[i:j] in model.ids or i + 1 == j]
