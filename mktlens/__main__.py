"""Command line: list or run registered queries.

    python -m mktlens list
    python -m mktlens run <key> [--data DIR] [--out PATH] [--show N] [--explain]

``run`` writes the result as parquet to ``--out`` (failing if it exists, as
CREATE TABLE AS does) or shows the first rows.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="mktlens")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list query keys")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("key")
    run.add_argument("--data", default="/root/testdata/sf0.01", help="folder of the driver parquet tables")
    run.add_argument("--out", help="parquet folder to write (must not exist)")
    run.add_argument("--show", type=int, default=20, help="rows to show when not writing")
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    args = parser.parse_args(argv)

    from mktlens.plans.registry import QUERIES
    if args.cmd == "list":
        for key in sorted(QUERIES):
            doc = (QUERIES[key].__doc__ or "").strip().splitlines()
            print(f"{key:40s} {doc[0] if doc else ''}")
        return 0

    from mktlens.session import local_session
    from mktlens.sources.sinks import ctas_sink
    spark = local_session()
    df = QUERIES[args.key](spark, args.data)
    if args.explain:
        df.explain("formatted")
    if args.out:
        ctas_sink(df, args.out)
        print(f"wrote {args.out}")
    else:
        df.show(args.show, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
