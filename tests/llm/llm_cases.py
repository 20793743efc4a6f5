"""Shared cases of the operator tests."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and empty texts, null ids, repeated rows, ties, odd white space, characters of one to four
#: bytes, and a long text.
ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (None, "no id here at all, only words", "en", None, 5),
    (None, "no id here at all, only words", "en", None, 5), (3, " \t\n\x0b\x0c\r ", None, "a", 7),
    (4, "one two three four five six seven\neight nine ten", "en", "b", 10),
    (4, "one two three four five six seven\neight nine ten", "en", "b", 10),
    (4, "another text with the same id\neight nine ten", "en", "b", 10),
    (5, "ONE two THREE four five six seven \n\n  eight nine ten\n", "en", "b", 10),
    (6, "ünï çödé 漢字 😀 words é́   nbsp   sep", "xx", "c", 10),
    (7, "word " * 30_000, "en", "c", 150_000), (8, "x" * 100_000, "en", "c", 100_000),
    (9, "a\x00b � <|endoftext|> ▁ <s> </s> <unk>", "en", "c", 1),
    (10, "\n\n\n", "en", "c", 3), (11, "ſecret: K K PASSWORD = 'ABCDEFGHIJKL12'", "en", "c", 3),
]


def clashing(df, *names):
    """The frame with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in (*names, "odd name-1.x")])


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)
