"""``python -m newsflow ingest|analyze``: the two stages over stored tables."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from newsflow.plans.analyze import Backends, backfill
from newsflow.plans.ingest import ingest_listings, ingest_news
from newsflow.schemas import RAW_NEWS
from newsflow.session import build_session, ship_packages
from newsflow.sources.landing import read_landed


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newsflow")
    stages = top.add_subparsers(dest="stage", required=True)
    ingest = stages.add_parser("ingest", help="land new articles")
    links = ingest.add_mutually_exclusive_group(required=True)
    links.add_argument("--listings", help="parquet: ticker, html of fetched listing pages")
    links.add_argument("--cards", help="parquet: ticker, pos, href, datetime")
    ingest.add_argument("--pages", required=True, help="parquet: url, html, status_code")
    ingest.add_argument("--base", required=True, help="landed news")
    ingest.add_argument("--run-id", default="local")
    ingest.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    ingest.add_argument("--max-articles", type=int, help="links per ticker at most; default all")
    ingest.add_argument("--nested-p", action="store_true", help="an open paragraph holds what follows")
    ingest.add_argument("--land-errors", action="store_true", help="land failed links instead of quarantining them")
    ingest.add_argument("--rewrite", action="store_true", help="merge touched days into fresh files")
    analyze = stages.add_parser("analyze", help="analyse landed articles")
    analyze.add_argument("--base", required=True)
    analyze.add_argument("--results", required=True)
    analyze.add_argument("--ticker")
    analyze.add_argument("--date", help="YYYY-MM-DD; skips the pending test")
    analyze.add_argument("--mode", choices=["all", "pending"], default="pending")
    analyze.add_argument("--report", type=int, default=50, help="failed days to name")
    analyze.add_argument("--weights", required=True, help="JSON file of word weights for the sentiment")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    ship_packages(spark, os.path.dirname(os.path.abspath(__file__)))
    if args.stage == "ingest":
        ingest = ingest_listings if args.listings else ingest_news
        ingest(
            spark.read.parquet(args.listings or args.cards),
            spark.read.parquet(args.pages),
            read_landed(spark, args.base, RAW_NEWS),
            args.base,
            rewrite=args.rewrite,
            land_errors=args.land_errors,
            nested_p=args.nested_p,
            as_of=args.as_of,
            run_id=args.run_id,
            fetched_at=F.current_timestamp(),
            max_articles=args.max_articles,
        ).drop()
    else:
        with open(args.weights, encoding="utf-8") as file:
            weights = json.load(file)
        done = backfill(
            spark,
            args.base,
            args.results,
            Backends(sentiment_weights=weights),
            args.ticker,
            args.date,
            args.mode,
        )
        counts = {r["status"]: r["count"] for r in done.outcomes.groupBy("status").count().collect()}
        print(f"days analysed: {counts.get('done', 0)}, failed: {counts.get('failed', 0)}")
        # The report names the first of many.
        for row in done.outcomes.filter("status = 'failed'").orderBy("ticker", "date").limit(args.report).collect():
            print(f"failed: {row['ticker']} {row['date']}: {row['error']}")


if __name__ == "__main__":
    main()
