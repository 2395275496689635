"""Command-line launcher for the streaming jobs.

  python -m logtide.streaming.run clicks   --table T [--writer W] (--kafka HOSTS --topic X | --files DIR | --text DIR)
  python -m logtide.streaming.run uniques  --table T [--writer W] ...
  python -m logtide.streaming.run archive  --path P --checkpoint C ...
  python -m logtide.streaming.run load     --path P --table T --checkpoint C        (what is new; e.g. from cron)
  python -m logtide.streaming.run load     --path P --table T --day yyyyMMdd ...    (batch: overwrites these days)

The session comes from the cluster (`spark-submit` configuration). Several queries can feed one table, each as a
writer of its own; a writer's checkpoint is inside the table. With Kafka, `--topic` subscribes and `--assign t:0,1,2`
names partitions. `--rate` is the per-partition message rate (the reference's 100/s) at the trigger in use and needs
the number of partitions. `--ledger F` records the offsets of every committed batch in the folder F, and
`--resume-from-ledger` starts a query that has no checkpoint yet from them, for the partitions named by `--assign` or
`--topic-partitions t:3` (all at 0 if one of them has none). A file at `--stop-file`, SIGTERM or Ctrl-C ends a job
after its running batch.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from logtide.operators.archive import load_archive
from logtide.operators.counters import CITY_DATE, DATE_CITY
from logtide.sources.messages import kafka_options, read_kafka, stream_messages, stream_text_lines
from logtide.streaming import jobs, ledger, state

DEFAULT_TRIGGERS = {"clicks": jobs.COUNTER_TRIGGER, "uniques": jobs.UNIQUES_TRIGGER, "archive": jobs.ARCHIVE_TRIGGER,
                    "load": "availableNow"}
_UNIT_SECONDS = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}


def trigger_seconds(trigger: str) -> float:
    """Length of a processing-time trigger such as "5 seconds" or "1 minute 30 seconds"."""
    words = trigger.lower().removeprefix("interval ").split()
    try:
        return sum(float(n) * _UNIT_SECONDS[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2], strict=True))
    except (KeyError, ValueError) as e:
        raise SystemExit(f"--rate needs a trigger of a fixed length, not {trigger!r}") from e


def topic_partitions(args) -> dict[str, list[int]]:
    """{topic: partitions} that `--assign` or `--topic-partitions` name."""
    out: dict[str, list[int]] = {}
    for text in args.assign or []:
        topic, _, listed = text.rpartition(":")
        out.setdefault(topic, []).extend(int(x) for x in listed.split(","))
    for text in args.topic_partitions or []:
        topic, _, count = text.rpartition(":")
        out.setdefault(topic, []).extend(range(int(count)))
    return {t: sorted(set(p)) for t, p in out.items()}


def parse_args(argv=None):
    """Command-line options of the launcher."""
    ap = argparse.ArgumentParser(prog="logtide.streaming.run")
    ap.add_argument("job", choices=["clicks", "uniques", "archive", "load"])
    ap.add_argument("--checkpoint", help="streaming checkpoint folder (archive, load)")
    ap.add_argument("--table", help="table folder (clicks, uniques, load)")
    ap.add_argument("--writer", default=jobs.DEFAULT_WRITER, help="name of this query among the table's (clicks, uniques)")
    ap.add_argument("--ledger", help="folder of the offset ledger")
    ap.add_argument("--stop-file", help="the job ends after its running batch once this file exists")
    ap.add_argument("--path", help="archive folder (archive)")
    src = ap.add_mutually_exclusive_group()
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of envelope Parquet files")
    src.add_argument("--text", help="folder of raw text lines")
    ap.add_argument("--topic", action="append", help="Kafka topic (repeatable)")
    ap.add_argument("--assign", action="append", help="topic:0,1,2 partitions to read (repeatable; instead of --topic)")
    ap.add_argument("--topic-partitions", action="append", help="topic:N, the topic has N partitions (repeatable)")
    ap.add_argument("--fail-on-data-loss", choices=["true", "false"], default="true",
                    help="false: skip offsets that have aged out of the topic")
    ap.add_argument("--group-id", help="Kafka consumer group name")
    ap.add_argument("--rate", type=int, help="max messages/s per Kafka partition")
    ap.add_argument("--partitions", type=int, help="Kafka partitions over all topics (for --rate; default: as named)")
    ap.add_argument("--max-files", type=int, help="files per trigger (file sources)")
    ap.add_argument("--resume-from-ledger", action="store_true")
    ap.add_argument("--trigger", help='"5 seconds", "availableNow", ...')
    ap.add_argument("--layout", choices=[DATE_CITY, CITY_DATE], default=DATE_CITY)
    ap.add_argument("--processing-time", action="store_true",
                    help="uniques/archive: bucket by the wall clock (automatic for --text)")
    ap.add_argument("--minute-as-dir", action="store_true", help="archive: .../HH/mm folders")
    ap.add_argument("--repartition", type=int)
    ap.add_argument("--day", action="append", help="load: yyyyMMdd to load again as a batch (repeatable)")
    ap.add_argument("--ttl", default=jobs.RETENTION, help="uniques: an hour expires this long after its last write")
    ap.add_argument("--watermark", default="10 minutes", help="uniques: how far messages may be behind the newest")
    return ap.parse_args(argv)


def kafka_source_options(spark: SparkSession, args) -> dict[str, str]:
    """The Kafka source's options for these arguments."""
    if bool(args.topic) == bool(args.assign):
        raise SystemExit("--kafka needs one of --topic and --assign")
    named = topic_partitions(args)
    starting = "earliest"
    if args.resume_from_ledger:
        if not args.ledger:
            raise SystemExit("--resume-from-ledger needs --ledger")
        if not named or not set(args.topic or named) <= set(named):
            raise SystemExit("--resume-from-ledger needs --assign, or --topic-partitions for every topic")
        parts = spark.createDataFrame([(t, p) for t, listed in named.items() for p in listed],
                                      "topic string, partition int")
        starting = ledger.ledger_start_offsets(spark, args.ledger, parts)
    partitions = args.partitions or sum(map(len, named.values())) or None
    return kafka_options(args.kafka, topics=args.topic, assign=named if args.assign else None,
                         starting_offsets=starting, max_rate_per_partition=args.rate,
                         batch_seconds=trigger_seconds(args.trigger or DEFAULT_TRIGGERS[args.job]) if args.rate else None,
                         partitions=partitions, group_id=args.group_id,
                         fail_on_data_loss=args.fail_on_data_loss == "true")


def source(spark: SparkSession, args):
    """The message stream the options name: Kafka, envelope files or raw text."""
    if args.kafka:
        return read_kafka(spark, kafka_source_options(spark, args))
    if args.files:
        return stream_messages(spark, args.files, max_files_per_trigger=args.max_files)
    return stream_text_lines(spark, args.text, max_files_per_trigger=args.max_files)


def start(spark: SparkSession, args):
    """The job's streaming query, started, and its checkpoint."""
    trigger = args.trigger or DEFAULT_TRIGGERS[args.job]
    if args.job == "load":
        return jobs.archive_load_stream(spark, args.path, args.table, args.checkpoint, args.minute_as_dir, trigger,
                                        "logtide-load", args.max_files), args.checkpoint
    messages = source(spark, args)
    # raw text lines carry no message timestamp: bucket by processing time then
    processing_time = args.processing_time or "timestamp" not in messages.columns
    if args.job == "clicks":
        query = jobs.click_counter_stream(spark, messages, args.table, args.writer, args.layout, trigger,
                                          args.repartition, "logtide-clicks")
    elif args.job == "uniques":
        query = jobs.hourly_uniques_stream(spark, messages, args.table, args.writer, processing_time, trigger,
                                           args.repartition, "logtide-uniques", args.ttl, args.watermark)
    else:
        return jobs.archive_stream(messages, args.path, args.checkpoint, args.minute_as_dir, trigger,
                                   "logtide-archive", processing_time), args.checkpoint
    return query, state.checkpoint_of(args.table, args.writer)


def main(argv=None) -> str | None:
    """Start the chosen job and wait for it; returns what ended it (None: a batch load)."""
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"logtide-{args.job}").getOrCreate()
    if args.job == "load" and (args.day or not args.checkpoint):
        # batch: parse archived lines of the given days (default all) into the day-partitioned table
        if not (args.path and args.table):
            raise SystemExit("load needs --path (archive) and --table")
        load_archive(spark, args.path, args.table, args.minute_as_dir, args.day)
        return None
    needed = {"clicks": ("table",), "uniques": ("table",), "archive": ("path", "checkpoint"),
              "load": ("path", "table")}[args.job]
    if any(getattr(args, name) is None for name in needed):
        raise SystemExit(f"{args.job} needs " + " and ".join(f"--{name}" for name in needed))
    if args.job != "load" and not (args.kafka or args.files or args.text):
        raise SystemExit("streaming jobs need one of --kafka/--files/--text")
    listener = ledger.OffsetLedger(spark, args.ledger) if args.ledger else None
    if listener:
        spark.streams.addListener(listener)
    try:
        query, checkpoint = start(spark, args)
        ended = jobs.run_until_stopped(query, args.stop_file)
    finally:
        if listener:
            spark.streams.removeListener(listener)
            listener.flush()
    if listener:
        ledger.catch_up(spark, checkpoint, args.ledger)
    return ended


if __name__ == "__main__":
    main()
