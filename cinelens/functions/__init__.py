"""Column -> Column helpers. Everything here compiles to Catalyst expressions
(no Python runs per row), so it stays inside whole-stage codegen."""

from .dates import (decade_label, decade_start, month_in, month_of, window_label,
                    window_start, year_in, year_of)
from .literals import (items_schema, matches_first, parse_bracket_list,
                       parse_names, parse_pylist, pylist_to_json)
from .money import exact_decimal, exact_mean, exact_sum, exact_total, profit, profit_percentage

__all__ = [
    "decade_label", "decade_start", "month_in", "month_of", "year_in", "window_label", "window_start",
    "year_of", "items_schema", "matches_first", "parse_bracket_list", "parse_names",
    "parse_pylist", "pylist_to_json", "exact_decimal", "exact_mean", "exact_sum", "exact_total", "profit",
    "profit_percentage",
]
