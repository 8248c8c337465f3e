"""The jobs as commands, for spark-submit or ``python -m punctual <job> ...``.

The session takes its master and resources from the submit command; paths are URIs.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from punctual.ml import features, models
from punctual.operators import checks, tables
from punctual.operators.text import word_count
from punctual.plans import sql
from punctual.plans.batch import run_batch
from punctual.runtime import scratch
from punctual.schema import CLICK_EVENT_SCHEMA, CONTRACTS, FLIGHT_EVENT_SCHEMA
from punctual.sources import files
from punctual.sources.publish import publish_dir
from punctual.streaming import events, sinks
from punctual.streaming.live import live_metrics


def etl(spark, args):
    """Raw header CSVs to year-partitioned Parquet."""
    if args.rejects:
        account = files.load_raw(spark, args.raw, args.cleaned, args.rejects, files_per_year=args.files_per_year)
        account.orderBy("file").show(100, truncate=False)
    else:
        raw = files.conform(files.read_raw_csv(spark, args.raw))
        rows = files.write_flights(raw, args.cleaned, files_per_year=args.files_per_year)
        print(f"{rows} rows in {args.cleaned}")
    files.read_flights(spark, args.cleaned).printSchema()


def aggregate(spark, args):
    """The seven tables as named CSV files."""
    outputs = tables.all_tables(files.read_flights(spark, args.cleaned))
    for name, df in outputs.items():
        path, rows = files.export_csv(checks.apply_contract(df, name), args.output, name, CONTRACTS[name].keys)
        print(f"{rows} rows in {path}")
    checks.reconcile_totals(outputs).orderBy("Metric", "Source").show(truncate=False)


def load(spark, args):
    """Every exported CSV of a directory into the published table of its name."""
    for name, rows in publish_dir(spark, args.directory, args.target).items():
        print(f"{rows} rows in {name}")


def train(spark, args):
    """Fit and compare the models; export the prediction table of the first one."""
    rows = features.training_rows(files.read_flights(spark, args.cleaned))
    train_part, test = features.split_hash(rows) if args.split == "hash" else features.default_split(rows)
    with scratch(spark, "training") as path:
        written = models.training_table(train_part, path)
        fitted = {kind: models.train(written, kind, written=True) for kind in args.models}
    models.compare(fitted, test).show(truncate=False)
    scored = models.predictions(models.score(fitted[args.models[0]], test), args.limit)
    name = "ml_delay_predictions"
    path, count = files.export_csv(checks.apply_contract(scored, name), args.output, name, CONTRACTS[name].keys)
    print(f"{count} rows in {path}")


def batch(spark, args):
    """All of the above in order, published under the contracts."""
    print(run_batch(spark, args.raw, args.cleaned, args.target, kinds=tuple(args.models)))


def stream(spark, args):
    """A topic into JSON files (clicks) or into the serving table (flights), rejects beside it, until stopped."""
    schema = FLIGHT_EVENT_SCHEMA if args.layout == "flights" else CLICK_EVENT_SCHEMA
    time = "event_timestamp" if args.layout == "flights" else None
    source = events.kafka_source(spark, args.servers, args.topic)
    good, bad = events.split_rejects(source, schema, time=time)
    if args.layout == "flights":
        sinks.start_serving_sink(events.with_event_time(good), args.output, args.checkpoint)
    else:
        sinks.start_json_sink(good, args.output, args.checkpoint)
    sinks.start_serving_sink(bad, f"{args.output}/_rejects", f"{args.checkpoint}/_rejects", "messages")
    spark.streams.awaitAnyTermination()


def live(spark, args):
    """Windowed live metrics of a topic of flight events; rejects beside them, until stopped."""
    source = events.kafka_source(spark, args.servers, args.topic)
    good, bad = events.split_rejects(source, FLIGHT_EVENT_SCHEMA, time="event_timestamp")
    windows = live_metrics(events.with_event_time(good), args.window)
    sinks.start_serving_sink(windows, args.output, args.checkpoint, "live_metrics", mode="update")
    sinks.start_serving_sink(bad, f"{args.output}/_rejects", f"{args.checkpoint}/_rejects", "messages")
    spark.streams.awaitAnyTermination()


def words(spark, args):
    """Word counts of text files, as CSV."""
    files.write_csv(word_count(files.read_lines(spark, args.input)), args.output)


def explore(spark, args):
    """A CSV as the view ``data``: schema, row count, preview, and a category count if a column is named."""
    df = files.read_csv_inferred(spark, args.input)
    sql.register({"data": df})
    df.printSchema()
    sql.total_rows(spark, "data").show()
    sql.preview(spark, "data").show()
    if args.column:
        sql.category_count(spark, "data", args.column).show()


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="punctual")
    jobs = main.add_subparsers(required=True)

    def job(run, *positional: str):
        added = jobs.add_parser(run.__name__, help=run.__doc__)
        added.set_defaults(run=run)
        for name in positional:
            added.add_argument(name)
        return added

    load_raw = job(etl, "raw", "cleaned")
    load_raw.add_argument("--files-per-year", type=int)
    load_raw.add_argument("--rejects", help="a folder for lines with a wrong number of fields; prints what was lost per file")
    job(aggregate, "cleaned", "output")
    job(load, "directory", "target")
    fit = job(train, "cleaned", "output")
    fit.add_argument("--models", nargs="+", default=["lr", "gbt"], choices=["lr", "gbt"])
    fit.add_argument("--split", default="default", choices=["default", "hash"])
    fit.add_argument("--limit", type=int, help="publish a repeatable sample of so many rows")
    job(batch, "raw", "cleaned", "target").add_argument("--models", nargs="*", default=["lr"])
    job(stream, "servers", "topic", "output", "checkpoint").add_argument(
        "--layout", default="clicks", choices=["clicks", "flights"]
    )
    job(live, "servers", "topic", "output", "checkpoint").add_argument("--window", default="1 minute")
    job(words, "input", "output")
    job(explore, "input").add_argument("--column")
    return main


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName("punctual").getOrCreate(), args)


if __name__ == "__main__":
    main()
