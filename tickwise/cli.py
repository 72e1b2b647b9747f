"""Entry point for the batch and streaming jobs.

  python -m tickwise.cli analysis --landing hdfs:///data/landing --out hdfs:///data/results
  python -m tickwise.cli forecast --landing hdfs:///data/landing --out hdfs:///data/results [--models LinearRegression]
  python -m tickwise.cli land --api-src ... --rss-src ... --root hdfs:///data/landing [--trigger "120 seconds"]

On a cluster: ``spark-submit --py-files tickwise.zip tickwise/cli.py <job> ...`` (zip of the
package directory), or the same via ``python -m`` with the master set in the environment.
"""

from __future__ import annotations

import argparse
import sys

from tickwise.constants import LANDING_TRIGGER, MODEL_ORDER


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickwise")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("analysis", help="three aggregates + result tables + combined document")
    a.add_argument("--landing", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--layout", default="parquet", choices=["array", "lines", "parquet"])
    f = sub.add_parser("forecast", help="features, models, selection, recursive forecast")
    f.add_argument("--landing", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--layout", default="parquet", choices=["array", "lines", "parquet"])
    f.add_argument("--models", nargs="+", default=list(MODEL_ORDER))
    f.add_argument("--keys", nargs="*", default=None, help="allow-list of symbols (default: all)")
    s = sub.add_parser("land", help="stream both topics into the landing table with live snapshots")
    s.add_argument("--api-src", required=True)
    s.add_argument("--rss-src", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--format", default="json", choices=["json", "kafka"])
    s.add_argument("--bootstrap", default=None)
    s.add_argument("--trigger", default=LANDING_TRIGGER)
    s.add_argument("--results", default=None, help="refresh result tables, forecasts and documents here with every batch")
    s.add_argument("--models", nargs="+", default=list(MODEL_ORDER))
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    from tickwise.session import build_session
    spark = spark or build_session(app=f"tickwise-{args.job}")
    if args.job == "analysis":
        from tickwise.plans.analysis_job import run_analysis
        run_analysis(spark, args.landing, args.out, layout=args.layout)
    elif args.job == "forecast":
        from tickwise.plans.analysis_job import normalize_prices
        from tickwise.plans.forecast_job import build_forecast, write_forecast_outputs
        from tickwise.schemas import PRICE_EVENT
        from tickwise.sources.landing import load_or_empty
        prices = normalize_prices(load_or_empty(spark, f"{args.landing}/api", PRICE_EVENT, args.layout))
        res = build_forecast(spark, prices, models=args.models, keys=args.keys)
        write_forecast_outputs(spark, res, args.out)
    else:
        from tickwise.schemas import NEWS_EVENT, PRICE_EVENT
        from tickwise.sources.kafka import read_topics
        from tickwise.streaming import ingest, refresh, snapshots
        # for Kafka the source argument is the topic name, for files it is the directory
        stream = read_topics(spark, {"api": args.api_src, "rss": args.rss_src}, fmt=args.format, bootstrap=args.bootstrap)
        api = [snapshots.price_snapshot_writer(f"{args.root}/live_api")]
        rss = [snapshots.news_snapshot_writer(f"{args.root}/live_rss")]
        if args.results:
            states = f"{args.root}/states"
            api += [refresh.results_refresher(states, "api", args.results),
                    refresh.forecast_refresher(f"{args.root}/api", f"{states}/forecast", args.results, args.models)]
            rss += [refresh.results_refresher(states, "rss", args.results)]
        query = ingest.start_pipeline(stream, args.root, {"api": PRICE_EVENT, "rss": NEWS_EVENT}, args.trigger,
                                      snapshot_fns={"api": refresh.in_turn(*api), "rss": refresh.in_turn(*rss)})
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
