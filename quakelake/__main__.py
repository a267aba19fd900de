"""Command line of the lake: ``python -m quakelake --lake FOLDER COMMAND ...``.

Everything lives under the lake folder: ``bronze/<feed>/ingest_date=YYYYMMDD``, ``silver_*``,
``gold_daily``, ``gold``, and for the tolerant path ``silver_tolerant`` and ``gold_tolerant``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quakelake.operators import analytics
from quakelake.plans import gold_since_week, load_daily, load_historic, load_tolerant, merge_gold
from quakelake.session import build_session, pin_utc
from quakelake.sources import (
    VersionedTable,
    land_documents,
    land_payloads,
    scan_documents,
    scan_lines,
)

QUESTIONS = {
    "count-by-area": analytics.count_by_area,
    "avg-magnitude-by-area": analytics.avg_magnitude_by_area,
    "count-by-day": analytics.count_by_day,
    "count-by-day-area": analytics.count_by_day_area,
    "half-count-by-day": analytics.half_count_by_day,
    "half-count-by-day-area": analytics.half_count_by_day_area,
    "top-area-of-week": analytics.top_area_of_week,
    "areas-over": analytics.areas_over,
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quakelake", description=__doc__)
    parser.add_argument("--lake", required=True, help="folder that the whole cluster can reach")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("land", help="land raw feed files under their date")
    land.add_argument("feed")
    land.add_argument("source", help="files, a folder or a glob; one document per file")
    land.add_argument("--day", help="run date, today by default")
    land.add_argument("--lines", action="store_true", help="the files hold one document per line")
    land.add_argument("--unchanged", action="store_true", help="keep the files' layout")
    for name in ("historic", "daily", "tolerant"):
        load = commands.add_parser(name, help=f"run the {name} load")
        load.add_argument("feed")
        load.add_argument("--ingest-date", action="append", help="YYYYMMDD; all dates by default")
        if name != "tolerant":
            load.add_argument("--multi-line", action="store_true", help="landed with --unchanged")
    merge = commands.add_parser("merge", help="upsert daily gold into gold")
    merge.add_argument("--ordered", action="store_true", help="store gold sorted by key")
    ask = commands.add_parser("ask", help="answer a question on gold")
    ask.add_argument("question", choices=sorted(QUESTIONS))
    ask.add_argument("--as-of", help="date of the last-week question")
    ask.add_argument("--magnitude", type=float, help="threshold of areas-over")
    ask.add_argument("--out", help="parquet folder for the whole answer; shown in part if unset")
    return parser


def _documents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    bronze = f"{args.lake}/bronze/{args.feed}"
    if args.multi_line:
        dates = args.ingest_date or ["*"]
        return scan_documents(spark, *[f"{bronze}/ingest_date={date}" for date in dates])
    return scan_lines(spark, bronze, args.ingest_date)


def _answer(args: argparse.Namespace, gold: DataFrame) -> DataFrame:
    options = {}
    if args.question == "top-area-of-week":
        options = {"as_of": args.as_of}
    elif args.question == "areas-over" and args.magnitude is not None:
        options = {"magnitude": args.magnitude}
    return QUESTIONS[args.question](gold, **options)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = pin_utc(spark or build_session())

    def table(name: str) -> VersionedTable:
        return VersionedTable(spark, f"{args.lake}/{name}")

    if args.command == "land":
        path = f"{args.lake}/bronze/{args.feed}"
        if args.unchanged:
            land_payloads(spark, args.source, path, args.day)
        else:
            land_documents(spark.read.text(args.source, wholetext=not args.lines), path, args.day)
    elif args.command == "historic":
        load_historic(_documents(spark, args), table("silver_historic"), table("gold"))
    elif args.command == "daily":
        load_daily(_documents(spark, args), table("silver_daily"), table("gold_daily"))
    elif args.command == "tolerant":
        lines = scan_lines(spark, f"{args.lake}/bronze/{args.feed}", args.ingest_date)
        load_tolerant(lines, f"{args.lake}/silver_tolerant", table("gold_tolerant"))
    elif args.command == "merge":
        merge_gold(table("gold"), table("gold_daily"), table("daily_keys"), ordered=args.ordered)
    else:
        gold = table("gold")
        rows = gold_since_week(gold, args.as_of) if args.question == "top-area-of-week" else gold.read()
        answer = _answer(args, rows)
        if args.out:
            answer.write.mode("overwrite").parquet(args.out)
        else:
            answer.show(truncate=False)


if __name__ == "__main__":
    main()
