"""Reading list-valued text columns without leaving the JVM.

Catalog files hold lists as Python literals, e.g.
``[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': "O'Neil"}]``.
The text is cut into tokens -- whole string literals, and what stands between
them. String literals are rewritten escape by escape as JSON strings; between
them ``None`` / ``True`` / ``False`` become JSON constants and trailing commas
go. A string's content is never touched by the rules for what stands outside.
Texts that hold only single-quoted strings without escapes take a shorter way
to the same result: they are cut at the quotes.

Text that still cannot be read (also text with anything after the closing
bracket) becomes NULL for that row, never an error; ``plans.catalog.parse_report``
counts such rows per column and the ingest jobs report the count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JSON_OPTS = {"allowSingleQuotes": "true", "allowUnquotedControlChars": "true", "mode": "PERMISSIVE"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _utf16_escape(m) -> Column:
    """``\\UXXXXXXXX`` (8 hex digits) -> JSON ``\\uHHHH\\uLLLL`` surrogate pair."""
    cp = F.conv(F.substring(m, 3, 8), 16, 10).cast("long")
    off = cp - F.lit(0x10000)
    hi = F.lpad(F.hex(F.lit(0xD800) + F.shiftright(off, 10)), 4, "0")
    lo = F.lpad(F.hex(F.lit(0xDC00) + off.bitwiseAND(0x3FF)), 4, "0")
    bmp = F.lpad(F.hex(cp), 4, "0")
    return F.when(cp < 0x10000, F.concat(F.lit("\\u"), bmp)).otherwise(
        F.concat(F.lit("\\u"), hi, F.lit("\\u"), lo))


# Python-only constants and their JSON spellings (fixed values).
_CONSTANTS = (("None", "null"), ("True", "true"), ("False", "false"))
# Python escapes that JSON spells differently (fixed values).
_ESCAPES = {"\\'": "'", "\\a": "\\u0007", "\\v": "\\u000b", "\\\n": ""}
# Escapes both languages share.
_SHARED = ("\\\\", "\\\"", "\\b", "\\f", "\\n", "\\r", "\\t")

_TOKEN = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"]"""
_PART = r"""(?s)\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\.|[^\\]++"""


def _string_part(p) -> Column:
    """One escape sequence, or a run without any, of a Python string as JSON text."""
    out = F.when(~p.startswith("\\"), F.replace(p, F.lit('"'), F.lit('\\"')))
    for py, js in _ESCAPES.items():
        out = out.when(p == F.lit(py), F.lit(js))
    out = out.when(p.isin(*_SHARED) | p.rlike(r"^\\u[0-9a-fA-F]{4}$"), p)
    out = out.when(p.rlike(r"^\\x[0-9a-fA-F]{2}$"), F.concat(F.lit("\\u00"), F.substring(p, 3, 2)))
    out = out.when(p.rlike(r"^\\U[0-9a-fA-F]{8}$"), _utf16_escape(p))
    octal = F.conv(F.substring(p, 2, 3), 8, 16)
    out = out.when(p.rlike(r"^\\[0-7]{1,3}$"), F.concat(F.lit("\\u"), F.lpad(octal, 4, "0")))
    return out.otherwise(F.concat(F.lit("\\"), p))  # not an escape in Python: both characters stay


def _token(t) -> Column:
    """A whole string literal, or the text between two of them, as JSON text."""
    inner = t.substr(F.lit(2), F.length(t) - F.lit(2))
    parts = F.transform(F.regexp_extract_all(inner, F.lit(_PART), 0), _string_part)
    string = F.concat(F.lit('"'), F.when(inner.contains("\\"), F.array_join(parts, "")).otherwise(
        F.replace(inner, F.lit('"'), F.lit('\\"'))), F.lit('"'))
    other = t
    for py, js in _CONSTANTS:
        other = F.regexp_replace(other, r"\b" + py + r"\b", js)
    other = F.regexp_replace(other, r",(\s*[\]}])", "$1")  # trailing comma
    other = F.regexp_replace(other, r"\b[uU]$", "")  # u'...' prefix
    return F.when(t.rlike(r"^['\"]") & (F.length(t) > 1), string).otherwise(other)


def pylist_to_json(c) -> Column:
    """Python literal text as JSON text (see the module's description)."""
    c = _c(c)
    # Without double quotes and backslashes every single quote begins or ends a string, so cutting
    # at the quotes gives what stands outside (even places) and inside (odd places) of strings.
    simple = ~(c.contains('"') | c.contains("\\") | c.contains("u'") | c.contains("U'")
               | c.rlike(r",\s*[\]}]"))
    constant = c.contains("None") | c.contains("True") | c.contains("False")

    def outside(x, i):
        out = x
        for py, js in _CONSTANTS:
            out = F.replace(out, F.lit(py), F.lit(js))
        return F.when(i % 2 == 0, out).otherwise(x)

    replaced = F.array_join(F.transform(F.split(c, "'", -1), outside), "'")
    tokens = F.transform(F.regexp_extract_all(c, F.lit(_TOKEN), 0), _token)
    return F.when(simple & ~constant, c).when(simple, replaced).otherwise(F.array_join(tokens, ""))


def parse_pylist(c, schema: T.DataType) -> Column:
    """Python list literal text -> typed array (NULL when it cannot be read).

    The list is read as the one field of an object, so that anything after its
    closing bracket makes the text unreadable instead of being ignored.
    """
    whole = T.StructType([T.StructField("v", schema)])
    text = F.concat(F.lit('{"v":'), pylist_to_json(c), F.lit("}"))
    return F.from_json(text, whole, _JSON_OPTS)["v"]


def items_schema(*keys: str) -> T.ArrayType:
    """Schema of a list of dicts with the given string keys."""
    return T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in keys]))


def parse_names(c, key: str = "name") -> Column:
    """``[{..., 'name': 'A'}, {..., 'name': 'B'}]`` -> ``['A', 'B']`` (all elements)."""
    return F.transform(parse_pylist(c, items_schema(key)), lambda x: x[key])


def matches_first(c, field: str = "department", value: str = "Directing",
                  take: str = "name", also: dict | None = None) -> Column:
    """Array holding ``take`` of the first matching element, or empty.

    An element matches when ``field`` equals ``value`` and every ``also``
    field equals its value. ``explode`` of the result yields one row per film
    that has a match and none otherwise -- no separate NOT NULL filter, which
    Catalyst would push below the projection and so parse the text twice.
    """
    also = dict(also or {})
    keys = [field, take] + [k for k in also if k not in (field, take)]
    arr = parse_pylist(c, items_schema(*keys))

    def hit(x):
        cond = x[field] == F.lit(value)
        for k, v in also.items():
            cond = cond & (x[k] == F.lit(v))
        return cond

    first = F.slice(F.filter(arr, hit), 1, 1)
    return F.transform(first, lambda x: x[take])


def parse_bracket_list(c) -> Column:
    """List text of a stored table -> array of texts.

    JSON text (what ``sources.writers.to_store_text`` writes) is read as JSON,
    so names with commas, quotes or backslashes survive. The unquoted form
    ``[A, B]`` is split: drop the outer brackets, split on commas, trim blanks
    and one layer of quotes, drop empty items (``[]`` -> ``[]``).
    """
    c = _c(c)
    json = F.from_json(c, T.ArrayType(T.StringType()))
    inner = c.substr(F.lit(2), F.length(c) - F.lit(2))
    parts = F.filter(F.transform(
        F.split(inner, ","),
        lambda x: F.regexp_replace(F.trim(x), r"^(['\"])(.*)\1$", "$2")), lambda x: x != F.lit(""))
    return F.coalesce(F.when(c.rlike(r'^\s*\[\s*("|\])'), json), parts)
