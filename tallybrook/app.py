"""The jobs, for ``spark-submit``: land events, settle them, keep the dashboard, publish.

The broker connector and the object-store filesystem come with the submit command
(``--packages``), credentials with the environment.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from tallybrook.operators.publish import publish_frame, unpublishable
from tallybrook.schemas import KINDS, TOPICS, ddl
from tallybrook.sources import lake
from tallybrook.sources import messages as source
from tallybrook.streaming import ingest, live, progress, publish

APP_NAME = "tallybrook"
FORMAT = source.KAFKA


def session() -> SparkSession:
    spark = SparkSession.builder.appName(APP_NAME).getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    # Event times carry no offset; they are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _subscribed(args: argparse.Namespace, topics=TOPICS) -> dict[str, str]:
    return source.kafka_source_options(
        args.servers,
        topics,
        starting=args.starting,
        max_per_trigger=args.max_per_trigger,
        max_per_task=args.max_per_task,
        fail_on_data_loss=args.fail_on_data_loss,
    )


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.keep_progress:
        spark.streams.addListener(progress.ProgressLog(spark, f"{args.base}/progress"))
    queries = ingest.land_all(
        lambda kind: source.stream_messages(spark, FORMAT, _subscribed(args, [kind.topic])),
        f"{args.base}/processed",
        f"{args.base}/checkpoints",
        rejects=f"{args.base}/rejected" if args.keep_rejects else None,
        gather_hours=not args.scatter_hours,
    )
    ingest.supervise(queries)


def run_live(spark: SparkSession, args: argparse.Namespace) -> None:
    arriving = source.stream_messages(spark, FORMAT, _subscribed(args))
    path, checkpoint = f"{args.base}/live", f"{args.base}/checkpoints/live"
    ingest.supervise([live.start_live(arriving, path, checkpoint)])


def run_settle(spark: SparkSession, args: argparse.Namespace) -> None:
    for kind in KINDS:
        lake.settle(spark, f"{args.base}/processed", kind, drop_live=args.drop_live)


def run_publish(spark: SparkSession, args: argparse.Namespace) -> None:
    sink = source.kafka_sink_options(args.servers)
    if not args.checkpoints:
        events = spark.read.parquet(args.events)
        publish_frame(events).write.format(FORMAT).options(**sink).save()
        if args.rejects:
            unpublishable(events).write.mode("append").parquet(args.rejects)
        return
    fields = {name: dtype for kind in KINDS for name, dtype in kind.fields.items()}
    events = spark.readStream.schema(ddl(fields)).parquet(args.events)
    queries = [publish.start_publishing(events, FORMAT, sink, f"{args.checkpoints}/sent")]
    if args.rejects:
        kept = f"{args.checkpoints}/rejected"
        queries.append(publish.start_rejecting(events, args.rejects, kept))
    ingest.supervise(queries)


def _default_base() -> str | None:
    bucket = os.environ.get("S3_BUCKET")
    if not bucket:
        return None
    return "/".join(filter(None, (f"s3a://{bucket}", os.environ.get("S3_PREFIX"))))


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog=APP_NAME, description=__doc__)
    servers = os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    parser.add_argument("--servers", default=servers)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, run in (("ingest", run_ingest), ("live", run_live)):
        job = jobs.add_parser(name)
        base = _default_base()
        job.add_argument("--base", default=base, required=base is None)
        job.add_argument("--starting", default="latest")
        job.add_argument("--max-per-trigger", type=int)
        job.add_argument("--max-per-task", type=int)
        job.add_argument("--fail-on-data-loss", action="store_true")
        job.set_defaults(run=run)
    jobs.choices["ingest"].add_argument("--scatter-hours", action="store_true")
    jobs.choices["ingest"].add_argument("--keep-rejects", action="store_true")
    jobs.choices["ingest"].add_argument("--keep-progress", action="store_true")
    settling = jobs.add_parser("settle")
    settling.add_argument("--base", default=_default_base(), required=_default_base() is None)
    settling.add_argument("--drop-live", action="store_true")
    settling.set_defaults(run=run_settle)
    sending = jobs.add_parser("publish")
    sending.add_argument("--events", required=True)
    sending.add_argument("--rejects")
    sending.add_argument("--checkpoints", help="publish continuously, from a folder of events")
    sending.set_defaults(run=run_publish)
    return parser


def main() -> None:
    args = arguments().parse_args()
    args.run(session(), args)


if __name__ == "__main__":
    main()
