"""Command line for the batch job: the most mentioned names per day.

    python -m tallyho top-names ./segments/*.csv --lines --days 10
    spark-submit --py-files tallyho.zip run.py top-names 's3a://bucket/feed/201502*.gkg.csv' \
        --out s3a://bucket/top          # run.py: from tallyho.__main__ import main; main()

With ``--out`` the result is written as Parquet (``day, rank, name, n``);
without it one line per day is printed, ``day [(name, n), ...]`` - the day
count bounds what reaches the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .functions.names import STRIP_MODES
from .operators import topnames
from .session import configure
from .sources import feed


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyho")
    sub = p.add_subparsers(dest="command", required=True)
    t = sub.add_parser("top-names", help="top k names per day of feed files")
    t.add_argument("paths", nargs="+", help="files, folders or globs (any Hadoop path)")
    t.add_argument("--lines", action="store_true", help="raw-line scan instead of the typed scan")
    t.add_argument("--k", type=int, default=topnames.DEFAULT_K, help="names per day")
    t.add_argument("--strip", choices=STRIP_MODES, default="last", help="cut the offset at the last or first comma")
    t.add_argument("--days", type=int, help="only the earliest N days")
    t.add_argument("--out", help="write Parquet here instead of printing")
    return p


def top_names(spark: SparkSession, args: argparse.Namespace):
    configure(spark)
    if args.lines:
        arts = feed.articles_from_lines(feed.read_lines(spark, args.paths))
    else:
        arts = feed.articles_from_typed(feed.read_typed(spark, args.paths))
    top = topnames.top_names_per_day(arts, k=args.k, strip=args.strip)
    if args.days:
        top = topnames.first_days(top, args.days)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tallyho").getOrCreate()
    top = top_names(spark, args)
    if args.out:
        top.write.mode("errorifexists").parquet(args.out)
        return 0
    for row in topnames.top_pairs(top).orderBy("day").toLocalIterator():
        pairs = ", ".join(f"({p['name']}, {p['n']})" for p in row["top"])
        print(f"{row['day']} [{pairs}]")
    return 0


if __name__ == "__main__":
    sys.exit(main())
