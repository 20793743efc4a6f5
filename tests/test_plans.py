"""Business questions on hand-written film rows."""

import datetime as dt

from cinelens import plans as P

FILM_SCHEMA = ("id long, title string, release_date date, budget double, revenue double, "
               "original_language string, runtime int, popularity double, vote_count long, "
               "genres array<string>, companies array<string>")


def film(i, year, month=1, budget=100.0, revenue=150.0, lang="en", runtime=90, pop=1.0,
         votes=10, genres=("Drama",), companies=("C",), title=None):
    d = dt.date(year, month, 1) if year else None
    return (i, title or f"t{i}", d, budget, revenue, lang, runtime, pop, votes,
            list(genres), list(companies))


def test_clean_catalog_rules(spark):
    rows = [
        (1, 10.0, "[{'id': 1, 'name': 'Drama'}]", dt.date(2000, 1, 1), 20.0, 81.0, "[{'name': 'c'}]", "a"),
        (2, 0.0, "[{'id': 1, 'name': 'Drama'}]", dt.date(2000, 1, 1), 20.0, 81.0, "[{'name': 'c'}]", "b"),
        (3, None, "[{'id': 1, 'name': 'Drama'}]", dt.date(2000, 1, 1), 20.0, 81.0, "[{'name': 'c'}]", "c"),
        (4, 10.0, "[]", dt.date(2000, 1, 1), 20.0, 81.0, "[{'name': 'c'}]", "d"),
        (5, 10.0, "[{'name': 'X'}]", dt.date(2000, 1, 1), 20.0, 81.0, "[]", "e"),
        (6, 10.0, "[{'name': 'X'}]", dt.date(2000, 1, 1), 20.0, 81.0, None, "f"),
        (7, 10.0, "[{'name': 'X'}]", None, 20.0, 81.0, "[{'name': 'c'}]", "g"),
        (8, 10.0, "[{'name': 'X'}]", dt.date(2000, 1, 1), 0.0, 81.0, "[{'name': 'c'}]", "h"),
        (1, 10.0, "[{'id': 1, 'name': 'Drama'}]", dt.date(2000, 1, 1), 20.0, 81.0, "[{'name': 'c'}]", "a2"),
    ]
    df = spark.createDataFrame(rows, "id int, budget double, genres string, release_date date, "
                                     "revenue double, runtime double, production_companies string, "
                                     "title string")
    out = {r.id: r for r in P.clean_catalog(df).collect()}
    assert sorted(out) == [1, 4]                 # 4: empty genre list is kept
    assert out[1].genres == ["Drama"] and out[1].runtime == 81 and out[1].title == "a"
    assert out[4].genres == []


def test_clean_credits(spark):
    df = spark.createDataFrame([("[{'name': 'a'}]", "[{'name': 'b'}]", 1), ("[]", "[{'name': 'b'}]", 2),
                                ("[{'name': 'a'}]", "[]", 3), (None, "[{'name': 'b'}]", 4),
                                ("[{'name': 'a'}]", "[{'name': 'b'}]", None)],
                               "cast string, crew string, id int")
    assert [r.id for r in P.clean_credits(df).collect()] == [1]


def test_top_rated_per_decade_ties_and_null_year(spark):
    ratings = spark.createDataFrame([(1, 4.5), (1, 4.5), (2, 4.0), (2, 5.0), (3, 3.0), (4, 5.0),
                                     (5, None), (5, 1.0)], "movieid long, ratings double")
    films = spark.createDataFrame([film(1, 1994), film(2, 1999), film(3, 1990), film(4, None),
                                   film(5, 2001)], FILM_SCHEMA)
    avg = P.avg_ratings_with_title_year(ratings, films)
    got = sorted(tuple(r) for r in P.top_rated_per_decade(avg).collect())
    assert got == [("t1", 4.5, "1990-2000"), ("t2", 4.5, "1990-2000"), ("t5", 1.0, "2000-2010")]


def test_profit_by_month_year_range(spark):
    films = spark.createDataFrame(
        [film(1, 1999), film(2, 2000, 3, revenue=300.0), film(3, 2000, 3, revenue=100.0),
         film(4, 2018, 12), film(5, 2019), film(6, 2000, 3, budget=0.0), film(7, 2000, 3, revenue=None)],
        FILM_SCHEMA)
    got = [tuple(r) for r in P.avg_profit_by_year_month(films).collect()]
    assert got == [(50.0, 2018, 12), (100.0, 2000, 3)]


def test_month_ranking(spark):
    films = spark.createDataFrame([film(1, 2001, 5, revenue=500.0), film(2, 2002, 5, revenue=100.0),
                                   film(3, 2003, 7, revenue=900.0)], FILM_SCHEMA)
    got = [(r.month, r.average_profit, r.rank) for r in P.month_ranking(films).collect()]
    assert got == [(7, 800.0, 1), (5, 200.0, 2)]


def test_trends_keep_null_decade(spark):
    films = spark.createDataFrame([film(1, 1994, votes=10), film(2, 1999, votes=20),
                                   film(3, None, votes=7), film(4, 2005, votes=1)], FILM_SCHEMA)
    assert [tuple(r) for r in P.votes_by_decade(films).collect()] == [(7.0, None), (15.0, 1990), (1.0, 2000)]
    assert [tuple(r) for r in P.releases_by_decade(films).collect()] == [(1, None), (2, 1990), (1, 2000)]


def test_genres_and_top_genre(spark):
    films = spark.createDataFrame([film(1, 1994, genres=("A", "B")), film(2, 1995, genres=("A",)),
                                   film(3, 1996, genres=()), film(4, None, genres=("A",))], FILM_SCHEMA)
    counts = P.genre_counts_by_decade(films)
    assert sorted(tuple(r) for r in counts.collect()) == [("A", "1990-2000", 2), ("B", "1990-2000", 1)]
    assert [tuple(r) for r in P.top_genre_per_decade(counts).collect()] == [("A", "1990-2000", 2)]


def test_genres_from_stored_text(spark):
    df = spark.createDataFrame([(dt.date(1994, 1, 1), "[A, B]"), (dt.date(1994, 1, 1), "[]")],
                               "release_date date, genres string")
    got = sorted(tuple(r) for r in P.genre_counts_by_decade(df).collect())
    assert got == [("A", "1990-2000", 1), ("B", "1990-2000", 1)]


def test_companies_loss_excluded_and_ties(spark):
    films = spark.createDataFrame([
        film(1, 1994, revenue=300.0, companies=("X", "Y")),   # profit 200 to both
        film(2, 1995, revenue=50.0, companies=("Z",)),         # loss, ignored
        film(3, 1996, revenue=120.0, companies=("Z",)),        # profit 20
        film(4, 2004, revenue=110.0, companies=("Q",)),
    ], FILM_SCHEMA)
    by = P.company_profit_by_decade(films, companies="companies")
    assert sorted(tuple(r) for r in by.collect()) == [
        ("Q", "2000-2010", 10.0), ("X", "1990-2000", 200.0), ("Y", "1990-2000", 200.0),
        ("Z", "1990-2000", 20.0)]
    top = [tuple(r) for r in P.top_company_per_decade(by).collect()]
    assert sorted(top) == [("1990-2000", "X", 200.0), ("1990-2000", "Y", 200.0), ("2000-2010", "Q", 10.0)]
    pct = {r.id: r.profit_percentage for r in P.profit_percentage(films).collect()}
    assert pct == {1: 200.0, 3: 20.0, 4: 10.0}


def test_longest_per_language(spark):
    films = spark.createDataFrame([film(1, 1994, lang="en", runtime=100, pop=1.0, title="b"),
                                   film(2, 1994, lang="en", runtime=100, pop=3.0, title="a"),
                                   film(3, 1994, lang="fr", runtime=200, pop=0.5, title="z")], FILM_SCHEMA)
    got = [tuple(r) for r in P.longest_per_language(films).collect()]
    assert got == [("z", 0.5, "fr", 200), ("a", 3.0, "en", 100)]


def _credits(spark, rows):
    return spark.createDataFrame(rows, "id long, cast string, crew string")


def test_directors_windows_from_min_year(spark):
    def crew(name, dept="Directing"):
        return f"[{{'department': 'Crew', 'job': None, 'name': 'x'}}, {{'department': '{dept}', 'job': 'Director', 'name': '{name}'}}]"
    films = spark.createDataFrame([film(1, 1902), film(2, 1911), film(3, 1912), film(4, 1950),
                                   film(5, 1905)], FILM_SCHEMA)
    credits = _credits(spark, [(1, "[]", crew("Ann")), (2, "[]", crew("Bob")), (3, "[]", crew("Ann")),
                               (4, "[]", crew("Cy")), (5, "[]", crew("Dee", dept="Sound"))])
    ratings = spark.createDataFrame([(1, 4.0), (2, 3.0), (3, 2.0), (4, 5.0), (5, 5.0)],
                                    "movieid long, ratings double")
    df = P.director_films(films, credits, ratings)
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4]   # film 5 has no Directing entry
    top = sorted((r.window, r.rank, r.director_name, r.movies_directed, r.ratings)
                 for r in P.top_directors_per_window(df, n=1, width=10).collect())
    assert top == [("1902-1911", 1, "Ann", "t1,t3", 4.0), ("1912-1921", 1, "Ann", "t1,t3", 2.0),
                   ("1942-1951", 1, "Cy", "t4", 5.0)]


def test_winner_without_titles_stays(spark):
    df = spark.createDataFrame([(1, None, 1990, "X", 5.0), (2, "t", 1991, "Y", 4.0)],
                               "id long, title string, year int, director_name string, ratings double")
    got = sorted((r["rank"], r.director_name, r.movies_directed)
                 for r in P.top_directors_per_window(df, n=2, width=10).collect())
    assert got == [(1, "X", ""), (2, "Y", "t")]


def test_close_scores_are_not_rounded_together(spark):
    df = spark.createDataFrame([(1, "t", 1990, "B", 4.0 + 1e-12), (2, "u", 1990, "A", 4.0)],
                               "id long, title string, year int, director_name string, ratings double")
    top = P.top_directors_per_window(df, n=1, width=10).first()
    assert (top.director_name, top.ratings) == ("B", 4.0 + 1e-12)


def test_year_span_and_row_counts(spark):
    films = spark.createDataFrame([film(1, 1902), film(2, 2017), film(3, None)], FILM_SCHEMA)
    assert tuple(P.year_span(films).first()) == (1902, 2017)
    got = {r.table_name: r.row_count for r in P.row_counts({"films": films, "one": films.limit(1)}).collect()}
    assert got == {"films": 3, "one": 1}


def test_text_release_dates_as_stored(spark):
    rows = [(1, "t1", "1994-05-01", 100.0, 300.0), (2, "t2", "2018-12-24", 100.0, 150.0),
            (3, "t3", None, 100.0, 150.0)]
    films = spark.createDataFrame(rows, "id long, title string, release_date string, "
                                        "budget double, revenue double")
    assert [tuple(r) for r in P.avg_profit_by_year_month(films).collect()] == [(50.0, 2018, 12)]
    assert [tuple(r) for r in P.releases_by_decade(films).collect()] == [(1, None), (1, 1990), (1, 2010)]
    assert tuple(P.year_span(films).first()) == (1994, 2018)


def test_directors_job_filter_and_calendar_windows(spark):
    crew = ("[{'department': 'Directing', 'job': 'Script Supervisor', 'name': 'Sam'}, "
            "{'department': 'Directing', 'job': 'Director', 'name': 'Dee'}]")
    credits = _credits(spark, [(1, "[]", crew)])
    assert [r.director_name for r in P.directors_of(credits).collect()] == ["Sam"]
    assert [r.director_name for r in P.directors_of(credits, job="Director").collect()] == ["Dee"]
    films = spark.createDataFrame([film(1, 1994), film(2, 2003)], FILM_SCHEMA)
    credits = _credits(spark, [(1, "[]", crew), (2, "[]", crew)])
    ratings = spark.createDataFrame([(1, 4.0), (2, 2.0)], "movieid long, ratings double")
    df = P.director_films(films, credits, ratings)
    got = [(r.window, r.ratings) for r in
           P.director_scores_by_window(df, 10, anchor="calendar").orderBy("window").collect()]
    assert got == [("1990-1999", 4.0), ("2000-2009", 2.0)]


def test_filmography_rows_match_joined_form(spark):
    df = spark.createDataFrame([(1, "b", 1990, "Ann", 4.0), (2, "a", 1991, "Ann", 3.0),
                                (3, "a", 1992, "Ann", 3.0), (4, "c", 1993, "Bob", 2.0)],
                               "id long, title string, year int, director_name string, ratings double")
    joined = {r.director_name: r.movies_directed for r in P.filmography(df).collect()}
    rows = P.filmography_rows(df).collect()
    long = {}
    for r in rows:
        long.setdefault(r.director_name, []).append(r.title)
    assert joined == {k: ",".join(sorted(v)) for k, v in long.items()}
    only = P.filmography_rows(df, spark.createDataFrame([("Bob",)], "director_name string"))
    assert [tuple(r) for r in only.collect()] == [("Bob", "c")]


def test_parse_report_counts_failures(spark):
    df = spark.createDataFrame([("[{'name': 'A'}, {'name': 'B'}]",), ("[]",), ("[{'name': 'x'",),
                                (None,), ("[{'name':None}]",), ("[] junk",)], "g string")
    r = P.parse_report(df, ["g"]).first()
    assert (r.g_rows, r.g_failed, r.g_items) == (5, 2, 3)


def test_ratings_join_with_raw_films_dedups_ids(spark):
    ratings = spark.createDataFrame([(1, 4.0), (1, 2.0)], "movieid long, ratings double")
    films = spark.createDataFrame([film(1, 1994, title="b"), film(1, 1994, title="a")], FILM_SCHEMA)
    assert P.avg_ratings_with_title_year(ratings, films).count() == 2          # keyed assumed
    rows = P.avg_ratings_with_title_year(ratings, films, films_keyed=False).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 1994, 3.0)]


def test_monthly_profit_counts_films_with_an_id(spark):
    rows = [film(1, 2001, 4, revenue=300.0), (None, "x", dt.date(2001, 4, 1), 100.0, 500.0, "en",
            90, 1.0, 1, ["Drama"], ["C"])]
    films = spark.createDataFrame(rows, FILM_SCHEMA)
    # (200 + 400) / count(id) = 600 / 1, as the source's sum(profit) / count(id)
    assert [tuple(r) for r in P.avg_profit_by_year_month(films).collect()] == [(600.0, 2001, 4)]
