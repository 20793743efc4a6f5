"""Operator 1: secret scans with structural confirmation.

Three plain patterns give the base findings. On top of them the operator looks
at base64, hex and dotted-token candidates and reports one only after decoding
it and checking its structure:

- ``der``: base64 or hex that decodes to a DER private key. Every length is
  checked against its container, down to the leaves, and the children must be
  those of PKCS#1 (two or more primes), PKCS#8 (plain or encrypted), SEC1 or the
  six integers of a DSA key.
- ``ssh``: the OpenSSH private key container, whose nested length-prefixed
  fields must use up the bytes exactly.
- ``jwt``: a signed token: JSON header naming an algorithm, JSON object as
  payload, signature length as the algorithm demands.

Base64 and hex may be wrapped over lines, by line breaks or by the escapes ``\\n``
and ``\\r`` of JSON, with or without BEGIN/END marks; base64 may use either
alphabet. A key's end is taken from its own outer length, so text that follows
on the next line does not hide it; what follows on the same line does. Tokens
are any three dotted base64url runs whose first two decode to JSON objects.
A run of lines is split once; at each line that may begin a key only the nested
lengths are decoded, so the time is proportional to the text.

Map-only: no shuffle, one row per document, memory bounded by one Arrow batch.

Cases: a null text is empty (no finding); a null id stays null; repeated rows
are scanned each for themselves; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import arrow_map, blobs, record_batch

#: Order of kinds at equal starts: the base kinds first, then the confirmed ones.
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt")

# Applied to ASCII-lower-cased bytes, hence lower case.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     rb"""([a-z0-9+/_.=-]+)""")
# Keywords are rare: a text without one is not scanned by the slower pattern.
_ASSIGN_HINT = (b"passw", b"secret", b"token", b"apikey", b"api_key")
# Runs are maximal, so the minimum lengths can stand in the patterns.
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(rb"[0-9a-f]{16,}")

# A break between lines, as it stands or escaped (once or more) as in JSON.
_BREAK = rb"(?:[\x20\t]*(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*)"
_BREAKS = re.compile(_BREAK)
# Before a start: no character of the alphabet, or the letter of an escaped break.
_START_B64 = re.compile(rb"(?:(?<![A-Za-z0-9+/_-])|(?<=\\n)|(?<=\\r)|(?<=-----))(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)"
                        rb"[A-Za-z0-9+/_-]{2}")
_START_HEX = re.compile(rb"(?:(?<![0-9A-Fa-f])|(?<=\\n)|(?<=\\r))(?:30|6[fF]70656[eE])[0-9A-Fa-f]{2}")
# From a start on: lines of the alphabet.
_RUN_B64 = re.compile(rb"[A-Za-z0-9+/_-]+(?:" + _BREAK + rb"[A-Za-z0-9+/_-]+)*={0,2}")
_RUN_HEX = re.compile(rb"[0-9A-Fa-f]+(?:" + _BREAK + rb"[0-9A-Fa-f]+)*")
_TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")

#: Signature bytes by algorithm (fixed values of the JWS algorithms); 0: at least 128.
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132,
              "EdDSA": 64, "RS256": 0, "RS384": 0, "RS512": 0, "PS256": 0, "PS384": 0, "PS512": 0}

_INT, _BITS, _OCTETS, _OID, _SEQ = 0x02, 0x03, 0x04, 0x06, 0x30


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the DER element at ``at``, or None if malformed."""
    if at + 2 > end:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n = int.from_bytes(data[at:at + size], "big")
        if n < 0x80 or (size > 1 and data[at] == 0):  # DER asks for the shortest form
            return None
        at += size
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int, depth: int = 0, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Elements that exactly fill ``data[at:end]``; nested containers are checked as well."""
    out = []
    while at < end:
        e = _tlv(data, at, end)
        if e is None or len(out) == most:
            return None
        if e[0] & 0x20 and (depth > 8 or _children(data, e[1], e[2], depth + 1) is None):
            return None
        out.append(e)
        at = e[2]
    return out


def is_private_der(data: bytes) -> bool:
    """Whether the bytes are exactly one DER private key."""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != _SEQ or top[2] != len(data):
        return False
    first = _tlv(data, top[1], top[2])
    if first is None or first[0] not in (_INT, _SEQ) or first[2] == top[2]:
        return False  # told from the first lengths alone: a version or an algorithm, and more behind it
    parts = _children(data, top[1], top[2], most=10)
    if not parts:
        return False
    tags = [p[0] for p in parts]

    def oid_first(part) -> bool:
        inner = _children(data, part[1], part[2])
        return bool(inner) and inner[0][0] == _OID and inner[0][2] > inner[0][1]

    if tags[0] == _INT and parts[0][2] - parts[0][1] == 1:
        version = data[parts[0][1]]
        if len(tags) == 9 and set(tags) == {_INT} and version == 0:
            return parts[1][2] - parts[1][1] >= 32  # the modulus
        if len(tags) == 10 and set(tags[:9]) == {_INT} and tags[9] == _SEQ and version == 1:
            # more primes: each with its exponent and coefficient
            others = _children(data, parts[9][1], parts[9][2])
            return parts[1][2] - parts[1][1] >= 32 and bool(others) and all(
                e[0] == _SEQ and [c[0] for c in _children(data, e[1], e[2])] == [_INT] * 3 for e in others)
        if len(tags) == 6 and set(tags) == {_INT} and version == 0:  # DSA: p, q, g, public, private
            p, q, _, _, x = (e[2] - e[1] for e in parts[1:])
            return p >= 64 and 20 <= q <= 33 and 1 <= x <= q
        if len(tags) >= 3 and tags[1:3] == [_SEQ, _OCTETS] and version <= 1:
            return oid_first(parts[1]) and parts[2][2] - parts[2][1] >= 16
        if len(tags) >= 2 and tags[1] == _OCTETS and version == 1:
            return parts[1][2] - parts[1][1] >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
        return False
    return tags == [_SEQ, _OCTETS] and oid_first(parts[0]) and parts[1][2] - parts[1][1] >= 16


def openssh_length(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key container that ``data`` begins with, by its nested lengths."""
    magic = b"openssh-key-v1\x00"
    if data[:len(magic)] != magic:
        return None
    at = len(magic)

    def number(at: int) -> int | None:
        return int.from_bytes(data[at:at + 4], "big") if at + 4 <= len(data) else None

    for _ in range(3):  # cipher, kdf, kdf options
        n = number(at)
        if n is None:
            return None
        at += 4 + n
    keys = number(at)
    if keys is None or not 1 <= keys <= 16:
        return None
    at += 4
    for _ in range(keys + 1):  # public keys, then the private section
        n = number(at)
        if not n:
            return None
        at += 4 + n
    return at if at <= len(data) else None


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are exactly one OpenSSH private key container."""
    return openssh_length(data) == len(data)


def _b64(text: bytes, alphabet: bytes = b"+/") -> bytes | None:
    text = text.rstrip(b"=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + b"=" * (-len(text) % 4), altchars=alphabet, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(token: bytes) -> bool:
    head, body, sign = token.split(b".")
    found = []
    for part in (head, body):
        raw = _b64(part, b"-_")
        try:
            found.append(json.loads(raw) if raw else None)
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(x, dict) for x in found):
        return False
    alg = found[0].get("alg")
    if not isinstance(alg, str) or alg not in _SIGNATURE:
        return False
    raw = _b64(sign, b"-_") or b""
    return len(raw) == _SIGNATURE[alg] if _SIGNATURE[alg] else len(raw) >= 128


def _wanted(head: bytes) -> int | None:
    """Bytes of the DER element that starts so, by its own length; None if unknown."""
    if len(head) < 2 or head[0] != _SEQ:
        return None
    n = head[1]
    if n < 0x80:
        return 2 + n
    size = n & 0x7F
    return 2 + size + int.from_bytes(head[2:2 + size], "big") if 1 <= size <= 4 and len(head) >= 2 + size else None


_TO_PLAIN = bytes.maketrans(b"-_", b"+/")


class _Run:
    """Lines of a base64 or hex run, read once; what starts at a line is decoded where it is looked at."""

    def __init__(self, data: bytes, start: int, hexadecimal: bool):
        found = (_RUN_HEX if hexadecimal else _RUN_B64).match(data, start)[0]
        # marks of dashes that stand right behind the base64 are not part of it
        run = found.partition(b"-----")[0]
        self.end = start + len(run)
        self.units, self.per = (2, 1) if hexadecimal else (4, 3)  # so many characters hold so many bytes
        self.starts, self.ends, at = [], [], 0
        for m in _BREAKS.finditer(run):
            self.starts.append(start + at)
            self.ends.append(start + m.start())
            at = m.end()
        if at < len(run):
            self.starts.append(start + at)
            self.ends.append(self.end)
        text = [data[a:b].rstrip(b"=") for a, b in zip(self.starts, self.ends)]
        #: characters up to the end of each line
        self.sums = list(accumulate(map(len, text)))
        self.text = b"".join(text) if hexadecimal else b"".join(text).translate(_TO_PLAIN)

    def key_at(self, place: int) -> tuple[int, str] | None:
        """(end in the text, kind) of the key that starts with the line at ``place``.

        Its own lengths say how long it is; it must end with a line.
        """
        k = bisect_left(self.starts, place)
        if k == len(self.starts) or self.starts[k] != place:
            return None
        before = self.sums[k - 1] if k else 0
        view = _Decoded(self, before, len(self.text) - before)
        kind, size = "der", _wanted(view[:6])
        if size is None:
            kind, size = "ssh", openssh_length(view)
        if size is None or size > len(view):
            return None
        chars = -(-size * self.units // self.per)
        line = bisect_left(self.sums, before + chars)
        if line == len(self.sums) or self.sums[line] != before + chars:
            return None
        if kind == "der" and not is_private_der(_Decoded(self, before, chars)):
            return None
        return self.ends[line], kind


class _Decoded:
    """Bytes of ``chars`` characters of a run, decoded piece by piece."""

    def __init__(self, run: _Run, before: int, chars: int):
        self.run, self.before, self.chars = run, before, chars

    def __len__(self) -> int:
        return self.chars * self.run.per // self.run.units

    def __getitem__(self, at):
        if isinstance(at, int):
            return self[at:at + 1][0]
        a, b, _ = at.indices(len(self))
        units, per, first = self.run.units, self.run.per, a // self.run.per
        text = self.run.text[self.before + first * units:self.before + min(self.chars, -(-b // per) * units)]
        raw = bytes.fromhex(text[:len(text) // 2 * 2].decode()) if units == 2 else binascii.a2b_base64(
            text[:-1] if len(text) % 4 == 1 else text + b"=" * (-len(text) % 4))
        return raw[a - first * per:b - first * per]


def confirmed_spans(data: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of candidates whose structure holds."""
    out = []
    for pattern, hexadecimal in ((_START_B64, False), (_START_HEX, True)):
        at, run = 0, None
        while m := pattern.search(data, at):
            if run is None or m.start() >= run.end:
                run = _Run(data, m.start(), hexadecimal)
            key = run.key_at(m.start())
            if key:
                out.append((m.start(), *key))
            at = key[0] if key else m.start() + 1  # a key may start in a later line of the same run
    if b"." in data:
        for m in _TOKEN.finditer(data):
            # the run may begin with the letter of an escaped break
            escaped = m[0][:1] in (b"n", b"r", b"t") and data[m.start() - 1:m.start()] == b"\\"
            out += [(m.start() + k, m.end(), "jwt") for k in range(1 + escaped) if is_signed_token(m[0][k:])][:1]
    return out


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of the three plain patterns."""
    low = data.lower()  # bytes.lower() changes A-Z only
    out = []
    if any(h in low for h in _ASSIGN_HINT):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(low) if len(m[2]) >= 12]
    out += [(*m.span(), "access") for m in _ACCESS.finditer(data)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(data)]
    return out


def in_code_points(data: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte offsets as code point offsets, sorted by start, then kind."""
    if not data.isascii():
        cuts = sorted({x for s in spans for x in s[:2]})
        at = {}
        done = points = 0
        for c in cuts:
            points += len(data[done:c].decode("utf-8", "replace"))
            done, at[c] = c, points
        spans = [(at[a], at[b], k) for a, b, k in spans]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                    ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                    ("n_confirmed", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        rows = [[] for _ in range(6)]
        for data in blobs(batch.column(1)):
            base, more = base_spans(data), confirmed_spans(data)
            spans = in_code_points(data, base + more) if base or more else []
            only = [s for s in spans if s[2] in KINDS[:3]]
            kinds = [s[2] for s in only]
            for out, value in zip(rows, (
                    kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                    hashlib.sha256(_written(only).encode()).hexdigest() if only else empty,
                    _written(spans), len(more))):
                out.append(value)
        yield record_batch(SCHEMA, [batch.column(0), *rows])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                 F.col(text_col).alias("text")), _scan,
                     "doc_id long, n_assign long, n_access long, n_hex long, "
                     "base_sha256 string, spans string, n_confirmed long")
