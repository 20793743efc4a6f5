"""Column functions on hand-written rows (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from cinelens.functions import (decade_label, decade_start, month_of,
                                parse_bracket_list, parse_names, window_label,
                                window_start, year_of)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_decade_label_and_start(spark):
    df = spark.createDataFrame([(1990,), (1994,), (1999,), (2000,), (None,)], "y int")
    got = {r.y: (r.s, r.l) for r in df.select("y", decade_start("y").alias("s"),
                                               decade_label("y").alias("l")).collect()}
    assert got[1990] == (1990, "1990-2000")
    assert got[1994] == (1990, "1990-2000")
    assert got[1999] == (1990, "1990-2000")
    assert got[2000] == (2000, "2000-2010")
    assert got[None] == (None, None)


def test_window_anchor_and_label(spark):
    df = spark.createDataFrame([(1902,), (1911,), (1912,), (1925,)], "y int")
    out = df.select("y", window_label(window_start("y", F.lit(1902), 10), 10).alias("w")).collect()
    got = {r.y: r.w for r in out}
    assert got == {1902: "1902-1911", 1911: "1902-1911", 1912: "1912-1921", 1925: "1922-1931"}


def test_year_month_from_date_and_text(spark):
    df = spark.createDataFrame([(dt.date(2018, 3, 9), "2018-03-09"), (None, "bad")],
                               "d date, t string")
    rows = df.select(year_of("d").alias("y"), month_of("d").alias("m"),
                     year_of("t", text=True).alias("ty"), month_of("t", text=True).alias("tm")).collect()
    assert (rows[0].y, rows[0].m, rows[0].ty, rows[0].tm) == (2018, 3, 2018, 3)
    assert (rows[1].y, rows[1].ty, rows[1].tm) == (None, None, None)


def test_parse_names_plain(spark):
    txt = "[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': 'Comedy'}]"
    assert one(spark, parse_names("v"), txt) == ["Animation", "Comedy"]


def test_parse_names_comma_apostrophe_and_empty(spark):
    assert one(spark, parse_names("v"), "[{'name': 'A, B'}]") == ["A, B"]
    assert one(spark, parse_names("v"), """[{'name': "O'Neil"}]""") == ["O'Neil"]
    assert one(spark, parse_names("v"), "[]") == []
    assert one(spark, parse_names("v"), None) is None


def test_parse_names_python_tokens(spark):
    txt = "[{'x': None, 'b': True, 'c': False, 'name': 'n'}]"
    assert one(spark, parse_names("v"), txt) == ["n"]


def test_parse_names_hex_escape(spark):
    txt = "[{'name': 'a\\xa0b'}]"  # backslash, x, a0 as in the files
    assert one(spark, parse_names("v"), txt) == ["a\xa0b"]  # no-break space


def test_parse_names_garbage_is_null_not_error(spark):
    assert one(spark, parse_names("v"), "[{'name': 'x'") is None


def test_parse_bracket_list(spark):
    assert one(spark, parse_bracket_list("v"), "[Drama, Comedy]") == ["Drama", "Comedy"]
    assert one(spark, parse_bracket_list("v"), '["Drama","Comedy"]') == ["Drama", "Comedy"]
    assert one(spark, parse_bracket_list("v"), "['Drama', 'Comedy']") == ["Drama", "Comedy"]
    assert one(spark, parse_bracket_list("v"), "[]") == []


def test_parse_bracket_list_reads_json_text(spark):
    import json
    names = ["Sci-Fi, Fantasy", 'He said "x"', "back\\slash", "it's", "tab\t", "]", ""]
    assert one(spark, parse_bracket_list("v"), json.dumps(names)) == names
    assert one(spark, parse_bracket_list("v"), '["a", b]') == ["a", "b"]     # not JSON: split


def test_stored_lists_come_back_as_written(spark):
    from cinelens.sources import to_store_text
    names = ["Sci-Fi, Fantasy", 'He said "x"', "back\\slash", "A"]
    df = to_store_text(spark.createDataFrame([(names,)], "v array<string>"))
    assert df.select(parse_bracket_list("v").alias("r")).first()["r"] == names


def test_parse_names_python_spellings(spark):
    for txt, want in [
            ("[{'x':None , 'ok' :True,'name': 'n'}]", ["n"]),
            ("""[{'id': 1, 'name': "a': None, b"}]""", ["a': None, b"]),
            (r"[{'name': 'a\\x41'}]", [r"a\x41"]),                # an escaped backslash before x41
            ("[{'name':None}]", [None]),
            ("[None, {'name': 'n'}]", [None, "n"]),
            ("[{'name': 'n',},]", ["n"]),
            (r"[{'name': 'a\ab'}]", ["a\x07b"]),
            (r"[{'name': 'it\'s \"q\" \101 \q'}]", ['it\'s "q" A \\q']),
            ("[{'name': u'n'}]", ["n"]),
            (r"[{'name': '\U0001F600 \u00e9'}]", ["\U0001F600 \u00e9"]),
            ("[{'name': 'n'}] junk", None),
            ("[{'name': 'n'}", None)]:
        assert one(spark, parse_names("v"), txt) == want, txt


def test_exact_sums_keep_every_digit_or_raise(spark):
    import pytest
    from pyspark.errors import PySparkException
    from cinelens.functions import exact_mean, exact_sum
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)

            def value(col, *xs):
                return spark.createDataFrame([(x,) for x in xs], "v double").select(col).first()[0]

            assert value(exact_mean("v"), 1 / 3, 1e-5) == (1 / 3 + 1e-5) / 2
            assert value(exact_mean("v"), 2e14, 1.0) == (2e14 + 1) / 2
            assert value(exact_sum("v"), 0.1, 0.2, None) == 0.3
            assert value(exact_mean("v"), None) is None
            for bad in (1e25, 1e-25, float("nan"), float("inf")):
                with pytest.raises(PySparkException):
                    value(exact_sum("v"), bad, 1.0)
            with pytest.raises(PySparkException):  # each value fits, the sum does not
                value(exact_sum("v"), 9e19, 9e19)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
