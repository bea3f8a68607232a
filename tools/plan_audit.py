"""Flag plan shapes that do not scale: nested-loop and cartesian joins, unpartitioned windows, Python in the plan.

``python tools/plan_audit.py [folder] [name part ...]``
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHAPES = {
    "nested loop": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "python": r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups",
    "global window": r"(?:Window|WindowGroupLimit) \[[^\n]*\n[ +\-:]*Sort[^\n]*\n[ +\-:]*Exchange SinglePartition",
    "collect_list": r"collect_list|collect_set",
    "percentile": r"percentile",
}


def findings(plan: str) -> list[str]:
    return [name for name, shape in SHAPES.items() if re.search(shape, plan)]


def main() -> None:
    from flowgauge.plans import load_all
    from flowgauge.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    for q in load_all().values():
        if args and not any(a in q.name for a in args):
            continue
        plan = q.run(spark, folder)._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan)
        print(q.name, "exchanges", len(re.findall(r"Exchange hash", plan)), "joins", len(joins), *findings(plan), sep=" | ")


if __name__ == "__main__":
    main()
