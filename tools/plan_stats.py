"""Print final-plan statistics (scans, shuffles, reuse, joins) of registered queries.

    python tools/plan_stats.py [--sf DIR] name ...
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans.registry import QUERIES, load_all  # noqa: E402
from kestrel.session import build_session  # noqa: E402

KEYS = ["Scan parquet", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
        "ReusedExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "Window", "Generate"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    load_all()
    spark = build_session("local[8]", 8)
    for n in a.names:
        df = QUERIES[n](spark, a.sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        stats = {k: final.count(k) for k in KEYS if final.count(k)}
        print(n, stats)


if __name__ == "__main__":
    main()
