"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelflow.plans import catalog  # noqa: E402
from parcelflow.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.spark_queries()
    for name in args or sorted(queries):
        print(f"===== {name}")
        queries[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
