"""Summarise the final physical plan of every registered query as Markdown.

Lands the test tables as catalog tables (deliveries and trips co-bucketed on
trip_id), lowers the broadcast threshold so only dimension-sized tables are
broadcast (as at scale, where trips and deliveries never are), runs every
table query of the catalog with the ``noop`` sink and counts the operators
of its final adaptive plan.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelflow.plans import catalog  # noqa: E402
from parcelflow.session import build_session  # noqa: E402
from parcelflow.sources import fleet_tables_from_catalog, write_fleet_catalog  # noqa: E402
from parcelflow.sources.driver_tables import fleet_tables_from_driver_data  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "partial aggs": r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_|SortAggregate\(key=\[[^\]]*\], functions=\[partial_",
    "windows": r"\bWindow \[",
    "group limits": r"WindowGroupLimit",
    "trip_id shuffles": r"Exchange hashpartitioning\(trip_id",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="run-plans-", dir="/tmp")
    spark = build_session(
        master="local[8]",
        shuffle_partitions=16,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "catalog"),
            "spark.sql.autoBroadcastJoinThreshold": str(256 * 1024),
            "spark.sql.adaptive.autoBroadcastJoinThreshold": str(256 * 1024),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    write_fleet_catalog(spark, fleet_tables_from_driver_data(spark, sf_dir), "fleet", buckets=8)
    tables = fleet_tables_from_catalog(spark, "fleet")
    cols = list(PATTERNS)
    print(f"# PLANS — final physical plans at {os.path.basename(sf_dir)}\n")
    print(
        "Generated by `tools/plan_summary.py`: deliveries and trips co-bucketed on `trip_id` (8 buckets), broadcast "
        "threshold 256 KB (dimensions broadcast, trips and deliveries never), AQE on, after execution. Counts are "
        "operators in the final adaptive plan; ETL rows read their checkpointed batch.\n"
    )
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, fn in catalog.table_queries().items():
        qe = fn(tables)._jdf.queryExecution()
        qe.toRdd().count()  # run this very plan so AQE finalises it
        plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        counts = Counter({k: len(re.findall(p, plan)) for k, p in PATTERNS.items()})
        print(f"| `{name}` | " + " | ".join(str(counts[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
