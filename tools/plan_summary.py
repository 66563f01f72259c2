"""Summarise the physical plan of every query of the base library into PLANS.md.

Usage: python tools/plan_summary.py [sf_dir]

For each query: shuffles (by kind), join strategies, WindowGroupLimit
(partial top-k before a shuffle), aggregates, scalar subqueries, scans with
their read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagesieve.plans import registry  # noqa: E402
from pagesieve.session import get_session  # noqa: E402

PATTERNS = {
    "shuffle hash": r"Exchange hashpartitioning",
    "shuffle range": r"Exchange rangepartitioning",
    "shuffle single": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "broadcast hash join": r"BroadcastHashJoin",
    "sort-merge join": r"SortMergeJoin",
    "shuffled hash join": r"ShuffledHashJoin",
    "nested-loop join": r"BroadcastNestedLoopJoin|CartesianProduct",
    "partial top-k (WindowGroupLimit)": r"WindowGroupLimit .*Partial",
    "window": r"\bWindow \[",
    "hash aggregate": r"HashAggregate\(",
    "scalar subquery": r"Subquery subquery",
    "python worker": r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow",
}


def summarise(plan: str) -> list[str]:
    lines = []
    counts = Counter()
    for label, pat in PATTERNS.items():
        n = len(re.findall(pat, plan))
        if n:
            counts[label] = n
    lines.append(", ".join(f"{k}: {v}" for k, v in counts.items()) or "no shuffle, no join")
    scans = re.findall(r"FileScan (\w+) \[[^\]]*\].*?PushedFilters: (\[[^\]]*\]).*?ReadSchema: (struct<[^\n]*?>)(?:\n|$)",
                       plan)
    for fmt, pushed, schema in sorted(set(scans)):
        lines.append(f"scan {fmt}: ReadSchema {schema[:160]}; PushedFilters {pushed[:120]}")
    return lines


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    out = ["# Physical plans (summary)", "",
           f"Generated by `tools/plan_summary.py` on `{os.path.basename(sf_dir)}` (local session, AQE on;",
           "initial plans, before AQE re-optimisation). Broadcasts of data-dependent sides come from the",
           "planner's size threshold, not from hints, except delete lists of up to 2**20 rows.", ""]
    for name, fn in registry.queries().items():
        if name == "stream_ingest":
            out += [f"## {name}", "", "- streaming: file source -> foreachBatch (dedupe, anti join, append)", ""]
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", ""] + [f"- {x}" for x in summarise(plan)] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
