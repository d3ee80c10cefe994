"""Write PLANS.md: the physical operators of every library query, in short.

Usage: python -m tests.plan_report [sf_dir]
"""

from __future__ import annotations

import re
import sys
from collections import Counter

from reelscope.plans.registry import QUERIES
from reelscope.session import drop_scratch, get_session

SHOWN = ("Scan parquet", "Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "WindowGroupLimit", "Generate", "Expand",
         "TakeOrderedAndProject", "Union")


def operators(df) -> str:
    text = df._jdf.queryExecution().executedPlan().treeString()
    names = Counter()
    for line in text.splitlines():
        m = re.match(r"[\s:+\-|]*(?:\*\(\d+\) )?([A-Za-z]+(?: parquet)?)", line)
        if m and (m[1] in SHOWN or m[1].startswith("FileScan")):
            names["Scan" if "Scan" in m[1] else m[1]] += 1
    return ", ".join(f"{n} {k}" for k, n in sorted(names.items()))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "",
           f"Operators in the initial physical plan (AQE re-plans at run time) of every library query on "
           f"`{sf_dir}`, from `python -m tests.plan_report`. Jobs that a query runs before (checkpoints, "
           "written tables, streams) are not in it; `bench.py` counts them from the event log.", "",
           "| query | what | operators |", "|---|---|---|"]
    for name in sorted(QUERIES):
        doc = " ".join((QUERIES[name].__doc__ or "").split()).split(". ")[0].rstrip(".").replace("|", "/")
        out.append(f"| `{name}` | {doc} | {operators(QUERIES[name](spark, sf_dir))} |")
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    drop_scratch(spark)
    print("wrote PLANS.md", len(out))


if __name__ == "__main__":
    main(sys.argv[1:])
