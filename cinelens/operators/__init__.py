"""DataFrame -> DataFrame building blocks. Column names are parameters, so the
same operator runs on the film files and on any table with the same roles."""

from .aggregates import (category_counts, collect_titles, explode_list,
                         longest_by, mean_by_key, trend)
from .chunks import collect_in_chunks
from .dedup import dedup_by_key
from .filters import keep_valid, null_audit
from .ranking import top_n_per_group, top_per_group
from .reuse import written_once

__all__ = [
    "category_counts", "collect_in_chunks", "collect_titles", "explode_list", "longest_by",
    "mean_by_key", "trend", "dedup_by_key", "keep_valid", "null_audit",
    "top_n_per_group", "top_per_group", "written_once",
]
