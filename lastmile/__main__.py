"""Command line: list queries, run one query, or run the whole pipeline.

  python -m lastmile list
  python -m lastmile query sla_breach /root/testdata/sf0.1 [--show 20] [--out path.parquet]
  python -m lastmile pipeline /root/testdata/sf0.1 /shared/out [--partition-orders-by-date]
  python -m lastmile load /shared/raw /shared/out [--feeds orders,riders] [--batch-ts 2024-05-06T07:00:00]

``--master`` runs locally (e.g. ``local[8]``); without it the cluster's settings stand.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from lastmile.registry import build, query_names
from lastmile.session import get_session
from lastmile.sources.schemas import FEEDS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lastmile")
    parser.add_argument("--master", default=None)
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name", choices=query_names())
    q.add_argument("sf_dir")
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--out", default=None, help="write the result as parquet instead of showing it")
    p = sub.add_parser("pipeline")
    p.add_argument("sf_dir")
    p.add_argument("out_dir")
    p.add_argument("--partition-orders-by-date", action="store_true")
    load = sub.add_parser("load", help="raw feed files to bronze, with a quarantine of the lines that do not parse")
    load.add_argument("raw_dir")
    load.add_argument("out_dir")
    load.add_argument("--feeds", default=",".join(FEEDS))
    load.add_argument("--batch-ts", type=dt.datetime.fromisoformat, default=None)
    args = parser.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(query_names()))
        return
    spark = get_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    if args.cmd == "query":
        df = build(args.name, spark, args.sf_dir)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
            print(args.out)
        else:
            df.show(args.show, truncate=False)
    elif args.cmd == "load":
        from lastmile.sources.feeds import load_all

        print(json.dumps(load_all(spark, args.raw_dir, args.out_dir, args.batch_ts, args.feeds.split(",")), indent=2))
    else:
        from lastmile.plans.pipeline import run_pipeline

        by = ("order_date",) if args.partition_orders_by_date else ()
        print(json.dumps(run_pipeline(spark, args.sf_dir, args.out_dir, by), indent=2))


if __name__ == "__main__":
    main()
