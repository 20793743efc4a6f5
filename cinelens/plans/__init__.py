"""The business questions, each a lazy DataFrame built from operators."""

from .bridge import (company_profit_from_bridge, crew_bridge, directors_from_bridge,
                     genre_counts_from_bridge, names_bridge, store_bridge)
from .catalog import clean_catalog, clean_credits, parse_report, raw_movies
from .companies import company_profit_by_decade, profit_percentage, top_company_per_decade
from .directors import (director_films, director_scores_by_window, directors_of,
                        filmography, filmography_chunks, filmography_rows,
                        top_directors_per_window)
from .genres import genre_counts_by_decade, top_genre_per_decade
from .profit import avg_profit_by_year_month, month_ranking
from .ratings import avg_rating_per_film, avg_ratings_with_title_year, top_rated_per_decade
from .reports import row_counts, year_span
from .trends import longest_per_language, releases_by_decade, votes_by_decade

__all__ = [
    "clean_catalog", "clean_credits", "parse_report", "raw_movies", "company_profit_by_decade",
    "profit_percentage", "top_company_per_decade", "director_films",
    "director_scores_by_window", "directors_of", "filmography", "filmography_rows",
    "top_directors_per_window", "genre_counts_by_decade", "top_genre_per_decade",
    "avg_profit_by_year_month", "month_ranking", "avg_rating_per_film",
    "avg_ratings_with_title_year", "top_rated_per_decade", "row_counts",
    "year_span", "longest_per_language", "releases_by_decade", "votes_by_decade",
]
