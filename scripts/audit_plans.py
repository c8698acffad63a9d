"""Print scale red flags found in each registered query's physical plan.

usage: python scripts/audit_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.catalogue import QUERIES  # noqa: E402
from quarry.session import local_session, plan_text  # noqa: E402

FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "ObjectHashAggregate", "HashAggregate",
         "Exchange SinglePartition", "WindowGroupLimit", "BroadcastHashJoin", "SortMergeJoin",
         "Generate", "Window ", "Subquery"]


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith(("/", "--"))] or sorted(QUERIES)
    spark = local_session(os.environ.get("AUDIT_CPUS", "8"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")          # whole read schemas
    md = "--md" in args
    if md:
        print("| query | shuffles | operators | scans (pruned read schema) |")
        print("| --- | --- | --- | --- |")
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = plan_text(df, "simple")
        found = {f.strip(): plan.count(f) for f in FLAGS if f in plan}
        found.pop("HashAggregate", None) if found.get("HashAggregate", 0) == found.get("ObjectHashAggregate", 0) \
            else None
        schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
        shuffles = plan.count("Exchange ") - plan.count("BroadcastExchange")
        if md:
            ops = ", ".join(f"{k}×{v}" for k, v in found.items())
            reads = "; ".join(sorted(set(x.replace("struct<", "").rstrip(">") for x in schemas)))
            print(f"| `{name}` | {shuffles} | {ops} | {reads} |")
        else:
            print(f"{name:22s} {found} shuffles={shuffles} reads={schemas}")


if __name__ == "__main__":
    main()
