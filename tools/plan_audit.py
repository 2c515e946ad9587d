"""Summarise the executed (final AQE) plan of registered queries.

Usage: python tools/plan_audit.py [sf_dir] [name ...]
Per query: shuffle exchanges, broadcast / sort-merge joins, window-group
limits, Python evaluation nodes, sort- vs hash-aggregates, scan pushdown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.plans.queries import REGISTRY  # noqa: E402
from barlake.session import get_session  # noqa: E402

NODES = ["BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit",
         "Window", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Expand",
         "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "TakeOrderedAndProject",
         "ReusedExchange"]


def audit(spark, name, sf):
    df = REGISTRY[name](spark, sf)
    df.collect()  # runs this frame's own plan, so that it is the final adaptive one; audits use a small sf
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    plan = plan.split("+- == Initial Plan ==")[0]
    counts = {
        "shuffles": len(re.findall(r"Exchange (hash|range|round)", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
    }
    counts = {k: v for k, v in counts.items() if v}
    for n in NODES:
        c = len(re.findall(rf"\b{n}\b", plan)) if n != "Window" else len(re.findall(r"\bWindow \[", plan))
        if c:
            counts[n] = c
    return counts


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(REGISTRY)
    spark = get_session(shuffle_partitions=8)
    for n in names:
        print(f"{n:24s} {audit(spark, n, sf)}")


if __name__ == "__main__":
    main()
