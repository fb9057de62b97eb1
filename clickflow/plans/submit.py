"""Command-line entry point for the four jobs (``spark-submit`` or ``python -m``).

    python -m clickflow.plans.submit session --input DIR --tasks PATH --task-id N --out DIR
    python -m clickflow.plans.submit page    --input DIR --tasks PATH --task-id N --out DIR
    python -m clickflow.plans.submit product --input DIR --tasks PATH --task-id N --out DIR
    python -m clickflow.plans.submit ads     --source DIR --out DIR [--threshold 100] [--trigger-seconds 5]
    python -m clickflow.plans.submit ads     --bootstrap-servers HOST:PORT --topics a,b --out DIR

``--input`` holds the input tables in the layout of ``clickflow.sources.tables``
(read through the adapter views); ``--tasks`` is a parquet table with
``task_id`` and ``task_param`` (JSON). Outputs are appended under ``--out``,
one folder per output table. The ad job runs until stopped, reading text
lines from ``--source`` (or the ``--topics`` of a message bus, which needs
Spark's Kafka connector package), with its checkpoint and stores under ``--out``.
On a cluster the master comes from spark-submit and ``spark.checkpoint.dir``
from the deployment.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from clickflow.plans import tasks
from clickflow.session import build_session
from clickflow.sources import native as N
from clickflow.sources import views as V
from clickflow.sources.task_params import lookup_task
from clickflow.streaming.ad_stream import AdClickStats, kafka_source, text_source


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="clickflow")
    ap.add_argument("job", choices=["session", "page", "product", "ads"])
    ap.add_argument("--input", help="folder of input tables (batch jobs)")
    ap.add_argument("--tables", choices=["stored", "derived"], default="derived",
                    help="stored: user_visit_action, user_info, product_info, city_info in --input (a folder or a database)")
    ap.add_argument("--levels", help='area levels of the product job as JSON, e.g. {"North": "A"}; other areas are D')
    ap.add_argument("--tasks", help="parquet task table (batch jobs)")
    ap.add_argument("--task-id", type=int)
    ap.add_argument("--out", required=True)
    ap.add_argument("--sample-size", type=int, default=100)
    ap.add_argument("--source", help="folder of ad log text files (ads job)")
    ap.add_argument("--bootstrap-servers", help="message-bus servers (ads job, with --topics)")
    ap.add_argument("--topics", help="comma-separated ad log topics (ads job)")
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--trigger-seconds", type=int, default=5)
    ap.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    return ap


def run(spark: SparkSession, args: argparse.Namespace):
    out = args.out.rstrip("/")
    if args.job == "ads":
        if args.topics:
            lines = kafka_source(spark, args.bootstrap_servers, args.topics)
        elif args.source:
            lines = text_source(spark, f"{args.source.rstrip('/')}/*")
        else:
            raise SystemExit("the ads job needs --source or --bootstrap-servers and --topics")
        stats = AdClickStats(spark, f"{out}/stores", args.threshold)
        return stats.start(lines, f"{out}/checkpoint",
                           {"processingTime": f"{int(args.trigger_seconds)} seconds"}, query_name="ad_click_stats")
    if not (args.input and args.tasks and args.task_id is not None):
        raise SystemExit("batch jobs need --input, --tasks and --task-id")
    p = lookup_task(spark.read.parquet(args.tasks), args.task_id)
    tables = N if args.tables == "stored" else V
    # stored tables compare the range in their own form, so that it prunes; derived ones push it from the typed column
    actions = N.user_visit_action(spark, args.input, p.start_date, p.end_date) if args.tables == "stored" else V.user_visit_action(spark, args.input)
    if args.job == "session":
        tasks.run_session_task(actions, tables.user_info(spark, args.input), p, args.task_id, out,
                               sample_size=args.sample_size)
    elif args.job == "page":
        tasks.run_page_task(actions, p, args.task_id, out)
    else:
        tasks.run_product_task(actions, tables.city_info(spark, args.input), tables.product_info(spark, args.input), p,
                               args.task_id, out, json.loads(args.levels) if args.levels else None)
    return None


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"clickflow-{args.job}")
    q = run(spark, args)
    if q is not None:
        q.awaitTermination()


if __name__ == "__main__":
    main()
