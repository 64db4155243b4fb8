"""`python -m forecourt`: run all layers."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from forecourt import fixed_values as fixed
from forecourt.config import BOOST, FOREST, Tables, Training
from forecourt.plans.medallion import Landed, run


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="forecourt", description=__doc__)
    parser.add_argument("--feed", help="folder of landed JSON feed pages")
    parser.add_argument("--pages", help="Parquet folder of landed (url, html) pages")
    parser.add_argument("--skip-ingest", action="store_true", help="use the stored raw tables")
    parser.add_argument(
        "--source", default="all", choices=["all", fixed.FEED_SOURCE, fixed.PAGE_SOURCE],
        help="train on listings of one source only",
    )
    parser.add_argument("--boost", action="store_true", help="also train boosted trees")
    parser.add_argument("--root", help="folder for the tables; catalog tables when not given")
    parser.add_argument("--output", required=True, help="folder for models and reports")
    parser.add_argument("--day", type=dt.date.fromisoformat, help="ingestion date; today when not given")
    parser.add_argument("--replace-dates", action="store_true", help="replace what is stored of the day")
    parser.add_argument("--keep-rejects", action="store_true", help="store rejected records, to be tried again")
    parser.add_argument("--as-of-year", type=int, help="year of reference; the running one when not given")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("forecourt").getOrCreate()
    sources = None
    if not given.skip_ingest:
        sources = Landed(given.feed, given.pages)
    models = (FOREST, BOOST) if given.boost else (FOREST,)
    summary = run(
        spark, Tables(root=given.root),
        Training(output_dir=given.output, source=given.source, models=models), sources,
        given.as_of_year, given.day, given.replace_dates, given.keep_rejects,
    )
    print(f"feed rows {summary.feed.rows}, page rows {summary.pages.rows}")
    for name, source in (("feed", summary.feed), ("page", summary.pages)):
        for reason, n in sorted(source.rejected.items()):
            print(f"{name} records rejected, {reason}: {n}")
    for outcome in summary.outcomes:
        print(f"run {outcome.run_id[:8]}  {outcome.params['model_type']}  {outcome.metrics}")
    if summary.skipped:
        print(f"no training: {summary.skipped}")


if __name__ == "__main__":
    main()
