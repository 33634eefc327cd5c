"""Summarise the executed (adaptive, final) plan of every registered query:
shuffles, broadcasts, join and aggregate kinds, scans with pushed filters,
and any cartesian / nested-loop join (there must be none).

    python tests/plan_review.py [sf_dir]  > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "hash_agg": r"(?<!Object)HashAggregate",
    "sort_agg": r"SortAggregate",
    "obj_agg": r"ObjectHashAggregate",
    "window": r"\bWindow\b",
    "generate": r"\bGenerate\b",
    "scans": r"FileScan \w+ ",
    "pushed": r"PushedFilters: \[(?!\])",
    "bad_joins": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def summarize(plan: str) -> dict:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    from optlake.session import get_session

    from optlake.plans.registry import QUERIES, load_all

    load_all()

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    rows = []
    for name, fn in sorted(QUERIES.items()):
        df = fn(spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this plan itself (JVM side), so AQE fixes its final plan
        plan = qe.executedPlan().toString()
        if "== Final Plan ==" in plan:
            plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        s = summarize(plan)
        rows.append((name, s))
    cols = list(PATTERNS)
    print("# Executed plans of the registered queries\n")
    print(f"Final adaptive plans at `{sf}` (local mode; AQE on).  Counts of plan nodes per query.  "
          "Streaming and store queries show the read of their sink; the merges inside them ran before "
          "(`tests/test_store.py` checks that those read only the touched partitions).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    bad = [n for n, s in rows if s["bad_joins"]]
    print(f"\nQueries with a cartesian or nested-loop join: {bad or 'none'}.")


if __name__ == "__main__":
    main()
