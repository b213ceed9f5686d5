"""Command line of the replication job."""

from __future__ import annotations

import argparse
import signal
import sys

from .functions.naming import parse_lsn, split_option
from .policy import ErrorPolicy


CONFIG_HELP = """-C K=V  option of the sink as a whole:
          kafka    any producer setting, sent as kafka.K (batch.size, linger.ms, security.protocol, ...)
          folder   compression, maxRecordsPerFile: settings of the Parquet writer
          console  rows: most messages shown of a batch
-T K=V  option of every topic:
          kafka    acks, compression.type, request.timeout.ms, delivery.timeout.ms
          folder   by_key=false: do not sort a topic's batch by key
"""


def lsn(text: str) -> int:
    return parse_lsn(text) if "/" in text else int(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tideline", description="Copy tables and their change log to topics.")
    p.add_argument("-d", "--source", help="folder of <table>.parquet to copy")
    p.add_argument("-l", "--log", help="folder of the change log to follow after the snapshot")
    p.add_argument("-s", "--slot", default="tideline", help="name of the checkpoint to resume from")
    p.add_argument("--checkpoint-dir", default="checkpoints", help="folder of checkpoints")
    p.add_argument("-b", "--sink", default="console", help="console, folder:<path> or kafka:<servers>")
    p.add_argument("-r", "--schema-registry", help="registry URL or file:<path>; avro output only")
    p.add_argument("-f", "--output-format", choices=("avro", "json"), default="avro")
    p.add_argument("-u", "--allow-unkeyed", action="store_true", help="copy tables without a key too")
    p.add_argument("-p", "--topic-prefix", help="put before every topic name, with a dot")
    p.add_argument("-e", "--on-error", choices=[x.value for x in ErrorPolicy], default="exit")
    p.add_argument("-x", "--skip-snapshot", action="store_true", help="follow the log only")
    p.add_argument("-C", "--sink-config", action="append", default=[], metavar="K=V", type=split_option)
    p.add_argument("-T", "--topic-config", action="append", default=[], metavar="K=V", type=split_option)
    p.add_argument("--config-help", action="store_true", help="list what -C and -T take, and exit")
    p.add_argument("--catalog", help="folder with class, namespace and index tables: tables and keys come from it")
    p.add_argument("--start-lsn", type=lsn, default=0, help="follow the log after this position, as a number or in the form 1/2F")
    p.add_argument("--until-end", action="store_true", help="stop at the end of the log instead of waiting for more")
    p.add_argument("-k", "--key", action="append", default=[], metavar="TABLE=COLUMNS", type=split_option)
    p.add_argument("-t", "--tables", default="%", help="LIKE pattern of table names")
    return p


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = parser()
    args = p.parse_args(argv)
    if not args.source and not args.config_help:
        p.error("the following arguments are required: -d/--source")
    if args.output_format == "json" and args.schema_registry:
        p.error("a schema registry cannot be used with JSON output")
    return args


def make_sink(text: str, options: dict[str, str], topic_options: dict[str, str] | None = None):
    """The sink that ``text`` names; ``options`` are of the sink as a whole, ``topic_options`` of its topics."""
    topic_options = topic_options or {}
    from .streaming.sinks import ConsoleSink, FolderSink, KafkaSink

    kind, _, where = text.partition(":")
    if kind == "console":
        return ConsoleSink(int(options.get("rows", 1000)))
    if kind == "folder" and where:
        return FolderSink(where, topic_options.get("by_key", "true").lower() != "false", options)
    if kind == "kafka":
        # The producer knows both kinds of settings by their own names; a topic's go before the sink's.
        return KafkaSink(where or "localhost:9092", {**options, **topic_options})
    raise ValueError(f"sink must be console, folder:<path> or kafka:<servers>, not {text!r}")


def make_registry(text: str | None):
    from .registry import FileRegistry, HttpRegistry

    if not text:
        return None
    return FileRegistry(text.removeprefix("file:")) if text.startswith("file:") else HttpRegistry(text)


def table_names(spark, folder: str, pattern: str) -> list[str]:
    """Names of ``<name>.parquet`` in a folder of any file system, LIKE the pattern."""
    import re

    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    like = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern), re.S)
    names = sorted(s.getPath().getName() for s in listed)
    return [n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and like.fullmatch(n.removesuffix(".parquet"))]


def tables_to_copy(spark, args: argparse.Namespace) -> list:
    """Tables by the catalog, if there is one, else by their files; keys that are given by hand go first."""
    from .sources import catalog

    keys = {name: columns.split(",") for name, columns in args.key}
    if not args.catalog:
        return [catalog.Table(i + 1, name, keys.get(name, [])) for i, name in enumerate(table_names(spark, args.source, args.tables))]
    parts = [spark.read.parquet(f"{args.catalog}/{n}.parquet") for n in ("class", "namespace", "index")]
    found = catalog.discover(*parts, args.tables)
    catalog.check(found, args.allow_unkeyed or bool(keys))
    # Catalog metadata: a row per table. The index's columns, where the catalog tells them, are the key.
    rows = found.orderBy("relid").collect()
    columns = {r["indexrelid"]: list(r["columns"]) for r in parts[2].collect()} if "columns" in parts[2].columns else {}
    return [catalog.Table(r["relid"], r["table_name"], keys.get(r["table_name"], columns.get(r["key_index_id"], [])), r["namespace"]) for r in rows]


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    if args.config_help:
        print(CONFIG_HELP, end="")
        return 0
    from pyspark.sql import SparkSession

    from .sources.changelog import log_end, register
    from .streaming.replicate import Job, drain, run

    spark = SparkSession.builder.appName("tideline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    tables = tables_to_copy(spark, args)
    job = Job(
        make_sink(args.sink, dict(args.sink_config), dict(args.topic_config)),
        f"{args.checkpoint_dir}/{args.slot}",
        args.output_format,
        make_registry(args.schema_registry),
        args.topic_prefix,
        args.allow_unkeyed,
        ErrorPolicy.parse(args.on_error),
    )
    read = lambda n: spark.read.parquet(f"{args.source}/{n}.parquet")
    if not args.log:
        run(spark, job, read, tables, skip_snapshot=args.skip_snapshot)
        return 0
    register(spark)
    schema = spark.read.parquet(args.log).schema
    log = spark.readStream.format("changelog").schema(schema).option("path", args.log).load()
    # An encoded log of events, or ready messages.
    follow = {"events": log} if "new_row" in schema.names else {"messages": log}
    trigger = None if args.until_end else {"processingTime": "1 second"}

    def start():
        return run(
            spark, job, read, tables, start_lsn=args.start_lsn, skip_snapshot=args.skip_snapshot,
            log_end=lambda: log_end(args.log), trigger=trigger, **follow,
        )

    if args.until_end:
        drain(start)
        return 0
    query = start()
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, lambda *_: query.stop())  # the batch at work is not acknowledged
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
