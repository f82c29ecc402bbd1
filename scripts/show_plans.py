"""Print the key operators of the executed physical plan of registered queries
(exchanges, scans with pushed filters and read schema, joins, windows,
aggregates, Python stages): ``python scripts/show_plans.py <name>...``; the
input folder is ``$SF_DIR`` (default sf0.1)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from widegrain.plans import registry  # noqa: E402
from widegrain.session import local_session  # noqa: E402

KEEP = ("Exchange", "Scan", "BroadcastHashJoin", "SortMergeJoin", "Window", "HashAggregate", "MapInArrow",
        "ArrowEvalPython", "BroadcastNestedLoop", "CartesianProduct", "Generate")


def main() -> None:
    spark = local_session(8, 8)
    registry.load_all()
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
    for name in sys.argv[1:]:
        df = registry.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print("=====", name)
        for line in plan.splitlines():
            if any(k in line for k in KEEP):
                print(re.sub(r"Location: \S+", "", line)[:260])


if __name__ == "__main__":
    main()
