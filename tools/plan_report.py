"""Summarise the physical plan of every registered query (for review).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per query: shuffles, join strategies, aggregate operators, whether whole-stage
codegen is used, and per Parquet scan the columns read and filters pushed.
Queries with eager steps (materialised ids, written intermediates) run those
steps while being planned.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from stellate.plans.catalog import QUERIES  # noqa: E402
from stellate.session import get_session  # noqa: E402

OPS = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
       "TakeOrderedAndProject", "Generate", "Expand")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "16",
                                                 "spark.sql.adaptive.enabled": "false"})
    print(f"# Physical plans of the registered queries ({sf_dir}, AQE off for a static view)\n")
    print("| query | shuffles | broadcasts | joins / aggregates | codegen stages |")
    print("| --- | --- | --- | --- | --- |")
    scans = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition|rebalance)", plan))
        bcasts = plan.count("BroadcastExchange")
        ops = [o for o in OPS for _ in re.findall(r"(?<![A-Za-z])" + o + r"[ (]", plan)]
        counted = {}
        for o in ops:
            counted[o] = counted.get(o, 0) + 1
        codegen = len(re.findall(r"\*\(\d+\)", plan))
        print(f"| {name} | {shuffles} | {bcasts} | "
              f"{', '.join(f'{k}×{v}' for k, v in counted.items()) or '–'} | {codegen} |")
        for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?PushedFilters: (\[[^\]]*\])", plan):
            scans.append((name, m.group(1), m.group(2)))
    print("\n## Parquet scans: columns read and filters pushed\n")
    print("| query | columns read | pushed filters |")
    print("| --- | --- | --- |")
    for name, cols, pushed in scans:
        cols = ", ".join(re.sub(r"#\d+L?", "", c).strip() for c in cols.split(","))
        print(f"| {name} | {cols} | {pushed} |")


if __name__ == "__main__":
    main()
