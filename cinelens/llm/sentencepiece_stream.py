"""Operator 4: SentencePiece encoding and decoding by a streaming Viterbi pass.

The model is a BPE vocabulary with byte fallback, so the right segmentation is
the one its merges give, not the one with the best sum of scores. The lattice
search still applies: a sequence of pieces is the BPE segmentation exactly if
every two neighbours are (each pair, merged alone, falls back into the same
two pieces). So an edge of the lattice is allowed if its piece goes with the
piece that ends where it starts; every boundary keeps one backpointer.

Streaming: pieces have a greatest length, so only the boundaries of the last
window can still be extended. Once the paths back from all of them meet in one
boundary, the pieces before it are final; their ids are committed and their
backpointers forgotten. Memory is the window plus the stretch not yet met.

No piece holds a blank mark after another character, so words (with the marks
before them) never share a piece: they are cut first, and a bounded cache in
each worker keeps the ids of short ones. Characters outside the vocabulary
become their UTF-8 bytes' ids.

Map-only: no shuffle. Cases: a null or empty text has no ids and decodes to an
empty text; a null id stays null; repeated rows are encoded each for
themselves; an empty table gives an empty result; ``encode_documents`` keeps
the other columns in a struct, so no name can clash.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import merge
from itertools import pairwise
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, row_schema

MARK = "▁"
#: What follows the last letter or digit of a word.
_TAIL = re.compile(r"(?<=\w)\W+$")
CACHE_SIZE, CACHED_CHARS, CHECK_EVERY = 1_000_000, 48, 64
_BASE = 1 << 21  # above the vocabulary and all code points


class Model:
    """Vocabulary of a SentencePiece BPE model file; segments by lattice search."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id = [sp.unk_id()] * 256
        self.raw: list[bytes] = []  # what each id decodes to
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.ids), default=1)
        # finds the pieces that end at each character, longest first
        self.pieces = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.pieces.add_word(p, (i, len(p)))
        self.pieces.make_automaton()
        self.single = {p for p in self.ids if len(p) == 1}
        self.size = sp.vocab_size()
        self.piece_of: list[str | None] = [None] * self.size
        for p, i in self.ids.items():
            self.piece_of[i] = p
        self.lengths = [len(p or "") for p in self.piece_of]
        chars = set("".join(self.ids))
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces cross blanks: words cannot be cut before encoding")
        # a line break outside the vocabulary's characters stands alone as well
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if "\n" in chars
                                else f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.plain = sp.normalize("a  b\tAéﬁ") == f"{MARK}a{MARK}{MARK}b\tAéﬁ"
        self.sp = sp
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    # -- segmentation

    def merge(self, text: str) -> list[str]:
        """BPE by definition: merge the neighbours whose piece scores best, leftmost first."""
        parts, get, none = list(text), self.score.get, -math.inf
        scores = [get(a + b, none) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > none:
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]  # those of the new piece and its neighbours have changed
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], none)
        return parts

    def text_of(self, code: int) -> str:
        return self.piece_of[code] if code < self.size else chr(code - self.size)

    def fit(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when merged side by side."""
        key = left * _BASE + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > CACHE_SIZE:
                self.pairs.clear()
            a, b = self.text_of(left), self.text_of(right)
            known = self.pairs[key] = self.merge(a + b) == [a, b]
        return known

    def _edges(self, text: str, start: int, stop: int) -> Iterable[tuple[int, tuple[int, int]]]:
        """(last character, (code, length)) of the edges that end at the boundaries up to ``stop``.

        By their end, longest first; those that end at ``start`` or before may be among them.
        """
        found = self.pieces.iter(text, max(0, start + 1 - self.longest), stop) if self.ids else ()
        if self.single.issuperset(text[start:stop]):
            return found
        alone = [(i, (self.size + ord(text[i]), 1)) for i in range(start, stop) if text[i] not in self.single]
        return merge(found, alone, key=itemgetter(0))

    def _extend(self, last: dict[int, int], text: str, start: int, stop: int) -> None:
        """Follow all edges that end at the boundaries ``start + 1`` to ``stop``."""
        pairs, done = self.pairs, start - 1
        for end, (code, length) in self._edges(text, start, stop):
            if end > done:
                before = last[end + 1 - length]  # every boundary is reached: single characters always are edges
                fits = pairs.get(before * _BASE + code) if before >= 0 else True
                if fits is None:
                    fits = self.fit(before, code)
                if fits:
                    last[end + 1], done = code, end

    def codes(self, text: str, check_every: int = CHECK_EVERY) -> Iterator[int]:
        """Codes of the pieces of ``text``, yielded as soon as they are final.

        A piece's code is its id; that of a character outside the vocabulary is the vocabulary's
        size plus its code point.
        """
        n, done = len(text), 0
        last = {0: -1}  # boundary -> the piece that ends there
        for i in range(0, n, check_every):
            stop = min(i + check_every, n)
            self._extend(last, text, i, stop)
            met = self._meeting(last, stop, done) if stop < n else n
            if met > done:
                yield from self._path(last, done, met)
                for k in range(done, met):
                    last.pop(k, None)
                done = met

    def segment(self, text: str, check_every: int = CHECK_EVERY) -> list[str]:
        return [self.text_of(c) for c in self.codes(text, check_every)]

    def _length(self, code: int) -> int:
        return self.lengths[code] if code < self.size else 1

    def _meeting(self, last: dict[int, int], at: int, done: int) -> int:
        """The boundary through which the paths of all boundaries that can be extended run."""
        live = {k for k in last if k >= max(at - self.longest + 1, done)}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - self._length(last[top]))
        return live.pop()

    def _path(self, last: dict[int, int], start: int, end: int) -> list[int]:
        out = []
        while end > start:
            code = last[end]
            out.append(code)
            end -= self._length(code)
        out.reverse()
        return out

    # -- ids

    def _ids(self, word: str) -> bytes:
        """Ids of a word, as bytes of 32-bit numbers."""
        tail = _TAIL.search(word)
        if tail:
            # the segmentations of two stretches, side by side, are that of the whole if the
            # pieces that meet fit; words with and without a comma then share their work
            head, rest = word[:tail.start()], tail[0]
            a, b = self.cached(head), self.cached(rest)
            left, right = int.from_bytes(a[-4:], "little"), int.from_bytes(b[:4], "little")
            if self.piece_of[left] is None:  # the last byte of a character outside the vocabulary
                left = self.size + ord(head[-1])
            if self.piece_of[right] is None:
                right = self.size + ord(rest[0])
            if self.fit(left, right):
                return a + b
        if len(word) <= CHECK_EVERY:
            last = {0: -1}
            self._extend(last, word, 0, len(word))
            codes = self._path(last, 0, len(word))
        else:
            codes = list(self.codes(word))
        if max(codes) >= self.size:
            codes = [i for c in codes for i in ([c] if c < self.size else map(
                self.byte_id.__getitem__, chr(c - self.size).encode("utf-8", "replace")))]
        return array("i", codes).tobytes()

    def cached(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            got = self._ids(word)
            if len(word) <= CACHED_CHARS:
                if len(self.cache) > CACHE_SIZE:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        text = MARK + text.replace(" ", MARK) if self.plain else self.sp.normalize(text)
        get, cached = self.cache.get, self.cached
        return np.frombuffer(b"".join([get(word) or cached(word) for word in self.words.findall(text)]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """One per worker and file."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            ids = [m.encode(t) for t in texts]
            same = [m.decode(i) == t.replace(MARK, " ") for i, t in zip(ids, texts)]
            counts = np.array([len(i) for i in ids], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                       pa.array(counts, pa.int64()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns + batch.columns[1:],
                                             names=["ids", "n_tokens", "round_trip",
                                                    *batch.schema.names[1:]])

    return run


def encode_documents(docs: DataFrame, path: str, text_col: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """(ids, n_tokens, round_trip, row): ``row`` holds the ``keep`` columns (default: all others).

    ``round_trip`` tells whether decoding the ids gives the text again.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    rows = docs.select(F.col(text_col).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    return arrow_map(rows, _encoder(path), row_schema("ids array<int>, n_tokens long, round_trip boolean",
                                                      row=rows.schema["row"].dataType))


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = [m.decode(np.array(i or [], np.int32)) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]],
                                             names=["text", *batch.schema.names[1:]])

    return run


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(text, row) from the encoder's rows."""
    rows = encoded.select("ids", "row")
    return arrow_map(rows, _decoder(path), row_schema("text string", row=rows.schema["row"].dataType))
