"""DataFrame operators on hand-written rows."""


from cinelens.operators import (category_counts, collect_titles, dedup_by_key,
                                keep_valid, longest_by, mean_by_key, null_audit,
                                top_n_per_group, top_per_group)


def test_keep_valid_three_valued(spark):
    df = spark.createDataFrame(
        [(1, 10.0, "[{'name': 'c'}]"), (2, 0.0, "[{'name': 'c'}]"), (3, None, "[{'name': 'c'}]"),
         (4, 5.0, "[]"), (5, 5.0, None), (None, 5.0, "[{'name': 'c'}]")],
        "id int, budget double, companies string")
    out = keep_valid(df, not_null=["id"], not_equal={"budget": 0, "companies": "[]"})
    assert sorted(r.id for r in out.collect()) == [1]


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, None)], "a int, b string")
    r = null_audit(df).first()
    assert (r.row_count, r.a_nulls, r.b_nulls) == (3, 1, 2)


def test_dedup_keeps_one_row_by_total_order(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "z", 1.0), (1, "a", 3.0)],
                               "id int, t string, v double")
    first = {r.id: (r.t, r.v) for r in dedup_by_key(df, ["id"]).collect()}
    assert first == {1: ("a", 3.0), 2: ("z", 1.0)}
    last = {r.id: (r.t, r.v) for r in dedup_by_key(df, ["id"], order=["v"], keep="last").collect()}
    assert last == {1: ("a", 9.0), 2: ("z", 1.0)}
    # idempotent, and the column order is kept
    once = dedup_by_key(df, ["id"])
    assert once.columns == df.columns
    assert sorted(dedup_by_key(once, ["id"]).collect()) == sorted(once.collect())


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("d1", "a", 4.5), ("d1", "b", 4.5), ("d1", "c", 3.0),
                                ("d2", "x", 1.0), ("d2", "y", None)], "g string, t string, v double")
    got = sorted((r.g, r.t) for r in top_per_group(df, "g", "v").collect())
    assert got == [("d1", "a"), ("d1", "b"), ("d2", "x")]


def test_top_n_tie_at_rank_n_keeps_lower_name(spark):
    rows = [("w", f"n{i}", float(10 - i)) for i in range(4)] + [("w", "zed", 6.0), ("w", "abe", 6.0)]
    df = spark.createDataFrame(rows, "g string, name string, v double")
    got = [(r.rank, r.name) for r in top_n_per_group(df, "g", "v", 5, tie_break="name")
           .orderBy("rank").collect()]
    assert got == [(1, "n0"), (2, "n1"), (3, "n2"), (4, "n3"), (5, "abe")]


def test_mean_ignores_null_and_is_exact(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, None), (2, None)], "k int, r double")
    got = {r.k: r.average for r in mean_by_key(df, "k", "r").collect()}
    assert got[1] == 0.15 and got[2] is None


def test_longest_by_tie_takes_smallest_title(spark):
    df = spark.createDataFrame([("en", "b", 100, 1.0), ("en", "a", 100, 2.0), ("en", "c", 90, 9.0),
                                ("en", None, 100, 0.5),
                                ("fr", "x", None, 5.0), ("fr", "y", 10, 1.0),
                                ("de", None, None, 1.0), ("de", "q", None, 2.0), ("it", None, 7, 1.0)],
                               "lang string, title string, runtime int, pop double")
    got = {r.lang: (r.title, r.runtime, r.pop) for r in
           longest_by(df, "lang", "runtime", "title", also_max=["pop"]).collect()}
    assert got == {"en": ("a", 100, 9.0), "fr": ("y", 10, 5.0), "de": ("q", None, 2.0),
                   "it": (None, 7, 1.0)}


def test_category_counts_empty_list_gives_no_row(spark):
    df = spark.createDataFrame([(["A", "B"], "1990-2000"), ([], "1990-2000"), (["A"], "2000-2010")],
                               "g array<string>, d string")
    got = sorted(tuple(r) for r in category_counts(df, "g", "genre", "d").collect())
    assert got == [("A", "1990-2000", 1), ("A", "2000-2010", 1), ("B", "1990-2000", 1)]


def test_collect_titles_sorted_distinct(spark):
    df = spark.createDataFrame([("d", "b"), ("d", "a"), ("d", "b"), ("e", None)], "k string, t string")
    got = {r.k: r.titles for r in collect_titles(df, "k", "t").collect()}
    assert got == {"d": "a,b"}
