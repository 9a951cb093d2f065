"""python -m docloom run|review|bundle: a run over tables, its review log and its bundle, from the command line."""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import SparkSession

from docloom import config as configs
from docloom import schema
from docloom.operators import reports, review
from docloom.plans import pipeline
from docloom.session import table
from docloom.sources import readers, writers


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="docloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="results of all documents of a folder of tables")
    run.add_argument("data", help="folder with router_decisions.parquet and segments.parquet")
    run.add_argument("out", help="folder for dataset.parquet, summary and quarantine")
    run.add_argument("--config", help="JSON or YAML file; what the command line gives goes before it")
    run.add_argument("--stages", nargs="*")
    run.add_argument("--vlm", action="store_true")
    run.add_argument("--no-quality", action="store_true")
    run.add_argument("--ocr-threshold", type=float)
    note = commands.add_parser("review", help="flag a document, or withdraw its flag, in a log")
    note.add_argument("log")
    note.add_argument("sha256")
    note.add_argument("--stage")
    note.add_argument("--note")
    note.add_argument("--tags", nargs="*")
    note.add_argument("--withdraw", action="store_true")
    bundle = commands.add_parser("bundle", help="totals, distributions and histograms of results as one JSON document")
    bundle.add_argument("results")
    bundle.add_argument("out")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    spark = spark or SparkSession.builder.appName("docloom").getOrCreate()
    if args.command == "run":
        given = dict(stages=args.stages, vlm=args.vlm, no_quality=args.no_quality, ocr_threshold=args.ocr_threshold)
        made = configs.load(args.config, **given) if args.config else configs.build({}, **given)
        writers.publish(pipeline.run(table(spark, args.data, "router_decisions"), table(spark, args.data, "segments"), made), f"{args.out}/{made.publish.out}", made.publish.compression)
        results = readers.result_table(spark, f"{args.out}/{made.publish.out}")
        writers.quarantine(results, f"{args.out}/quarantine")
        reports.run_summary(results.withColumnRenamed("pdf_path", "result_id")).coalesce(1).write.mode("overwrite").json(f"{args.out}/summary")
    elif args.command == "review":
        at = datetime.datetime.now(datetime.UTC).isoformat()
        record = review.unflag(args.sha256, at=at) if args.withdraw else review.flag(args.sha256, stage=args.stage, note=args.note, tags=args.tags, at=at)
        writers.append_log(spark.createDataFrame([record], schema.BAD_CASES), args.log)
    else:
        reports.view_bundle(spark.read.parquet(args.results)).coalesce(1).write.mode("overwrite").text(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
