"""The batch jobs from the command line, for spark-submit.

The session takes its master and settings from the submit command.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starledger.plans import jobs
from starledger.sources import Store


def _option(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starledger", description=__doc__)
    parser.add_argument("--root", help="folder of the tables; leave out for a connector")
    parser.add_argument("--format", default="parquet", help="table format or connector")
    parser.add_argument(
        "--option", type=_option, action="append", default=[], metavar="KEY=VALUE",
        help="reader and writer option; may be given several times",
    )
    parser.add_argument("--name-option", default="collection", help="option naming the table")
    parser.add_argument("--rating-table", default="Rating")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="parse the text sources into tables")
    load.add_argument("products")
    load.add_argument("ratings")
    load.add_argument("--product-table", default="Product")
    load.add_argument("--no-trim", dest="trim", action="store_false")
    load.add_argument("--mode", choices=["strict", "drop", "permissive"], default="strict")
    load.add_argument("--rejected-table", default="RejectedLines")
    load.add_argument("--max-rejected", type=int)
    load.add_argument("--unindexed", dest="indexed", action="store_false")

    statistics = commands.add_parser("statistics", help="compute the leaderboards")
    statistics.add_argument("--popular-table", default="RateMoreProducts")
    statistics.add_argument("--monthly-table", default="RateMoreRecentlyProducts")
    statistics.add_argument("--top-rated-table", default="AverageProducts")
    statistics.add_argument("--tz")
    statistics.add_argument("--text-month", action="store_true")
    statistics.add_argument("--files", type=int)

    refresh = commands.add_parser("refresh", help="count new rating files and update the leaderboards")
    refresh.add_argument("ratings")
    refresh.add_argument("--counts-table", default="RatingCounts")
    refresh.add_argument("--mode", choices=["strict", "drop"], default="strict")
    refresh.add_argument("--tz")
    refresh.add_argument("--text-month", action="store_true")
    refresh.add_argument("--files", type=int)

    lists = commands.add_parser("product-lists", help="train and store product lists")
    lists.add_argument("--user-table", default="UserRecs")
    lists.add_argument("--product-table")
    lists.add_argument("-n", type=int, default=20)
    lists.add_argument("--unfiltered", dest="min_score", action="store_const", const=None, default=0.0)
    lists.add_argument("--rank", type=int, default=5)
    lists.add_argument("--iterations", type=int, default=10)
    lists.add_argument("--reg", type=float, default=0.01)
    lists.add_argument("--seed", type=int, default=0)
    lists.add_argument("--cache", action="store_true")
    lists.add_argument("--files", type=int)
    lists.add_argument("--solver", choices=["ml", "sums"], default="ml")
    return parser


def main(argv: list[str] | None = None) -> None:
    given = vars(arguments().parse_args(argv))
    command = given.pop("command")
    store = Store(
        root=given.pop("root"),
        format=given.pop("format"),
        options=dict(given.pop("option")),
        name_option=given.pop("name_option"),
    )
    spark = SparkSession.builder.appName(f"starledger-{command}").getOrCreate()
    if command == "load":
        jobs.load(spark, store, given.pop("products"), given.pop("ratings"), **given)
    elif command == "statistics":
        jobs.statistics(spark, store, **given)
    elif command == "refresh":
        del given["rating_table"]
        jobs.refresh_statistics(spark, store, given.pop("ratings"), **given)
    else:
        jobs.product_lists(spark, store, **given)


if __name__ == "__main__":
    main()
