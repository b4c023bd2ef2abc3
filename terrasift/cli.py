"""Command line (C13): list queries, run one over a folder of tables, sniff a file, plan an area's tiles, write the demonstration packs."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("terrasift").getOrCreate()


def _queries() -> dict:
    from terrasift.plans import load
    from terrasift.plans.registry import QUERIES

    load()
    return QUERIES


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terrasift")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of all queries")
    run = sub.add_parser("run", help="run a query over a folder of Parquet tables")
    run.add_argument("query")
    run.add_argument("tables")
    run.add_argument("--out", help="folder for the result as Parquet; without it, the first rows are shown")
    sniff = sub.add_parser("sniff", help="a file's format")
    sniff.add_argument("file")
    tiles = sub.add_parser("tiles", help="tiles of a box x0,y0,x1,y1")
    tiles.add_argument("box")
    tiles.add_argument("--step", type=float, default=1.0)
    tiles.add_argument("--most", type=int, default=200)
    months = sub.add_parser("months", help="addresses that a pattern with {month} and {year} stands for")
    months.add_argument("pattern")
    demo = sub.add_parser("demo", help="write the demonstration packs")
    demo.add_argument("folder")
    demo.add_argument("--box")
    return p


def main(argv: list[str] | None = None) -> int:
    """0 if it worked, 1 if what is asked for is not there or no data, 2 for a command that can't be read."""
    a = parser().parse_args(argv)
    box = lambda text: tuple(float(v) for v in text.split(","))
    if a.command == "list":
        print("\n".join(sorted(_queries())))
    elif a.command == "run":
        if a.query not in _queries():
            print(f"no query {a.query!r}", file=sys.stderr)
            return 1
        out = _queries()[a.query](_spark(), a.tables)
        if a.out:
            out.write.parquet(a.out)
        else:
            out.show(20, truncate=False)
    elif a.command == "sniff":
        from terrasift.sources.files import NotData
        from terrasift.sources.files import sniff as kind

        try:
            with open(a.file, "rb") as f:
                print(kind(a.file, f.read(512)))
        except (OSError, NotData) as e:
            print(e, file=sys.stderr)
            return 1
    elif a.command == "tiles":
        from terrasift.catalog import tiles

        try:
            print("\n".join(",".join(f"{v:g}" for v in t) for t in tiles(box(a.box), a.step, a.most)))
        except ValueError as e:
            print(e, file=sys.stderr)
            return 1
    elif a.command == "months":
        from terrasift.sources.fetch import months

        print("\n".join(months(a.pattern, dt.date.today())))
    elif a.command == "demo":
        from terrasift.demo import pack

        os.makedirs(a.folder, exist_ok=True)
        for r in pack(_spark(), box(a.box) if a.box else None).toLocalIterator():  # one small archive at a time
            with open(os.path.join(a.folder, f"{r.doc}.kmz"), "wb") as f:
                f.write(r.kmz)
    return 0


if __name__ == "__main__":
    sys.exit(main())
