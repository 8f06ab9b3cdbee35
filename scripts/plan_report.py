"""Summarise the final (AQE) physical plan of every registered query.

usage: python scripts/plan_report.py [sf_dir] > plans.md
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.plans.registry import QUERIES  # noqa: E402
from barsmith.session import get_session  # noqa: E402

PATTERNS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single exch": r"Exchange SinglePartition",
    "reused exch": r"ReusedExchange",
    "broadcast": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "hash agg": r"HashAggregate\(",
    "sort agg": r"SortAggregate\(",
    "object agg": r"ObjectHashAggregate\(",
    "window": r"\bWindow \[",
    "top-k": r"TakeOrderedAndProject",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(conf={"spark.sql.shuffle.partitions": "16"})
    cols = list(PATTERNS)
    print("| query | " + " | ".join(cols) + " | pushed filters | table:columns read |")
    print("|---|" + "---|" * (len(cols) + 2))
    for key, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()
        plan = final_plan(df)
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        pushed = sorted({f for m in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) for f in m.split(", ") if f})
        reads = sorted({f"{t}:{len(c.split(','))}" for c, t in
                        re.findall(r"FileScan \w+ \[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[[^\]]*?/([\w.=-]+)\]", plan)})
        print(f"| `{key}` | " + " | ".join(c if c != "0" else "" for c in counts)
              + f" | {'; '.join(pushed)[:80]} | {reads} |")
    spark.stop()


if __name__ == "__main__":
    main()
