"""Summarise the physical plan of every registered film query (markdown table).

    python benchmarks/plan_census.py /root/testdata/sf0.1 > PLANS_census.md

Counts, per query, the shuffles (hash / range / single-partition exchanges),
broadcasts, sort-merge joins, aggregates (hash / sort-based / object), window
operators and partial group limits, scalar subqueries, and the widest scan
(ReadSchema column count) in the plan Spark chooses before execution. AQE may
still turn a sort-merge join into a broadcast join once it has measured the
sides; ``benchmarks/skew_check.py`` and ``explain()`` after an action show the
final plan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def census(plan: str) -> dict:
    def n(pat):
        return len(re.findall(pat, plan))
    widest = max((s.count(":") for s in re.findall(r"ReadSchema: struct<([^>\n]*)>", plan)), default=0)
    return {
        "shuffles": n(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "broadcasts": n(r"BroadcastExchange"),
        "smj": n(r"SortMergeJoin"),
        "bhj": n(r"BroadcastHashJoin"),
        "hash_agg": n(r"HashAggregate\("),
        "sort_agg": n(r"SortAggregate\("),
        "obj_agg": n(r"ObjectHashAggregate\("),
        "window": n(r"(?m)^\s*[:+\- ]*Window \["),
        "group_limit": n(r"WindowGroupLimit"),
        "subquery": n(r"Subquery subquery"),
        "widest_scan_cols": widest,
    }


def main(argv):
    d = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from cinelens.queries import QUERIES
    from cinelens.session import local_session
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    cols = None
    lines = []
    for name, q in QUERIES.items():
        c = census(q(spark, d)._jdf.queryExecution().executedPlan().toString())
        if cols is None:
            cols = list(c)
            lines.append("| query | " + " | ".join(cols) + " |")
            lines.append("|---" * (len(cols) + 1) + "|")
        lines.append(f"| {name} | " + " | ".join(str(c[k]) for k in cols) + " |")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
