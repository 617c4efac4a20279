"""Print the physical plan of registered queries.

usage: python scripts/explain.py NAME [NAME ...] [--sf DIR] [--final]

``--final`` runs the query first (into the noop sink) and prints the adaptive plan as
executed, with AQE's runtime decisions (broadcast conversions, skew splits, coalescing).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lastmile.registry import build, query_names  # noqa: E402
from lastmile.session import get_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="+", choices=query_names())
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--final", action="store_true")
    args = parser.parse_args()
    spark = get_session(master="local[8]", shuffle_partitions=8)
    for name in args.names:
        df = build(name, spark, args.sf)
        print(f"===== {name}")
        if args.final:
            df.collect()
            print(df._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain("formatted")


if __name__ == "__main__":
    main()
