"""Command line: ``python -m rillflow.cli COMMAND``."""

from __future__ import annotations

import argparse
import csv
import json
import platform
import sys
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import rillflow
from rillflow.codecs.registry import FolderRegistry, HttpRegistry, Registry
from rillflow.config import ConfigError, load, load_script, plural, seconds
from rillflow.model import EARLIEST
from rillflow.plans.etl import Pipeline, explain, plan
from rillflow.session import session
from rillflow.sources.pool import Pool
from rillflow.streaming.log import FileLog, KafkaLog
from rillflow.streaming.move import Codec, follow, from_log, produce, to_log


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rillflow", description="Moves change records between topic logs and pools, and transforms them.")
    sub = p.add_subparsers(dest="command")

    def command(name: str, help_: str, topic: bool = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=help_)
        c.add_argument("--log", default="log", help="folder of the topic logs")
        c.add_argument("--lake", default="lake", help="folder of the pools")
        c.add_argument("--format", default="json", help="json or avro")
        c.add_argument("--kafka", default="", help="JSON file with a broker's client settings; topics are there, not in --log")
        c.add_argument("--registry", default="", help="folder of the schema registry")
        c.add_argument("--registry-url", default="", help="a registry over HTTP")
        c.add_argument("--registry-user", default="")
        c.add_argument("--registry-password", default="")
        c.add_argument("--namespace", default="")
        c.add_argument("--master", default="local[*]")
        if topic:
            c.add_argument("--topic", default="")
        return c

    c = command("from-log", "topics into pools")
    c.add_argument("--pool", default="")
    c.add_argument("--shaper", default="")
    c.add_argument("--per-batch", type=int, default=0, help="most records of a micro-batch (most runs of a log in files)")
    c.add_argument("--max-records", type=int, default=1 << 20, help="most records of a commit")
    c.add_argument("--max-topic-bytes", type=int, default=1 << 20, help="most bytes of a topic in a commit")
    c.add_argument("--interval", default="", help="keep running, a commit at most so often")
    c.add_argument("--exit-after", default="")
    c.add_argument("--checkpoint", default="", help="a folder that driver and executors share; below --lake by default")
    c.add_argument("files", nargs="*", help="transform files whose inputs to read")
    c = command("to-log", "a pool's records into a topic")
    c.add_argument("--pool", default="")
    c.add_argument("--shaper", default="")
    c.add_argument("--partitions", type=int, default=1, help="of a topic that is new")
    c.add_argument("--replication", type=int, default=1, help="of a topic that is new")
    c = command("etl", "run a transform", topic=False)
    c.add_argument("--explain", action="store_true")
    c.add_argument("--expire", action="append", default=[], metavar="TOPIC=OFFSET", help="give up what is pending below an offset, and run nothing")
    c.add_argument("file")
    c = command("produce", "files into a topic")
    c.add_argument("files", nargs="+", help="JSON lines, CSV or Parquet; - for JSON lines from the standard input")
    c = command("consume", "print a topic")
    c.add_argument("--offset", type=int, default=EARLIEST)
    c.add_argument("--timeout", default="0s", help="wait so long for another record")
    c.add_argument("--output", choices=["json", "csv"], default="json")
    c.add_argument("--meta", action="store_true", help="with topic and offset")
    command("info", "a topic's first and next offset")
    command("ls", "registered schemas", topic=False)
    c = command("create", "a new pool", topic=False)
    c.add_argument("pool")
    sub.add_parser("version", help="print the version")
    return p


def sources(args: argparse.Namespace) -> dict[str, list[str]]:
    """The topics of each pool, from options and transform files."""
    if bool(args.pool) != bool(args.topic):
        raise ConfigError("--pool and --topic go together")
    out: dict[str, list[str]] = {}
    if args.pool:
        out[args.pool] = [args.topic]
    for f in args.files:
        for r in load(f).inputs:
            topics = out.setdefault(r.pool, [])
            if r.topic not in topics:
                topics.append(r.topic)
    if not out:
        raise ConfigError("no inputs: give --pool and --topic, or transform files")
    return out


def run(argv: list[str] | None = None, spark=None) -> int:
    p = parser()
    args = p.parse_args(argv)
    if not args.command:
        p.print_help()
        return 0
    if args.command == "version":
        print(f"rillflow {rillflow.__version__} (Python {platform.python_version()})")
        return 0
    try:
        if args.command in ("to-log", "produce", "consume", "info") and not args.topic:
            raise ConfigError("a topic is needed")
        if args.command == "to-log" and not args.pool:
            raise ConfigError("a pool is needed")
        wanted = sources(args) if args.command == "from-log" else {}
        if args.command == "etl" and args.explain:
            print(explain(plan(load(args.file))))
            return 0
        return _with_spark(args, spark or session(args.master), wanted)
    except (ConfigError, ValueError, LookupError) as e:
        print(f"rillflow: {e}", file=sys.stderr)
        return 1


def offsets(texts: list[str]) -> dict[str, int]:
    out = {}
    for text in texts:
        topic, _, at = text.rpartition("=")
        if not topic or not at.isdigit():
            raise ConfigError(f"not of the form topic=offset: {text!r}")
        out[topic] = int(at)
    return out


def registry_of(args: argparse.Namespace) -> Registry:
    if args.registry_url:
        return HttpRegistry(args.registry_url, args.registry_user, args.registry_password)
    return FolderRegistry(args.registry) if args.registry else Registry()


def log_of(args: argparse.Namespace, spark) -> FileLog | KafkaLog:
    return KafkaLog(spark, json.loads(load_script(args.kafka))) if args.kafka else FileLog(spark, args.log)


def frames_of(spark, paths: list[str]) -> list[DataFrame]:
    """The records of files, or of the standard input."""
    out = []
    for f in paths:
        if f == "-":
            out.append(spark.read.json(spark.sparkContext.parallelize([x for x in sys.stdin if x.strip()])))
        else:
            out.append(spark.read.json(f) if f.endswith((".json", ".jsonl")) else spark.read.csv(f, header=True) if f.endswith(".csv") else spark.read.parquet(f))
    return out


def show(df: DataFrame, output: str) -> None:
    """A row a line, as JSON or as CSV with a head; nested values in CSV are JSON."""
    if output == "json":
        for row in df.toJSON().toLocalIterator():
            print(row)
        return
    write = csv.writer(sys.stdout, lineterminator="\n")
    write.writerow(df.columns)
    nested = (T.StructType, T.ArrayType, T.MapType)
    plain = df.select(*[(F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")).alias(f.name) for f in df.schema.fields])
    for row in plain.toLocalIterator():
        write.writerow(["" if x is None else x for x in row])


def _with_spark(args: argparse.Namespace, spark, wanted: dict[str, list[str]]) -> int:
    codec, log = Codec(args.format, registry_of(args), args.namespace), log_of(args, spark)
    match args.command:
        case "create":
            Pool.create(spark, f"{args.lake}/{args.pool}")
            print(f"pool created: {args.pool}")
        case "from-log":
            pools = {n: Pool.open(spark, f"{args.lake}/{n}") for n in wanted}
            said, _ = from_log(log, pools, wanted, args.checkpoint or f"{args.lake}/_checkpoints/{uuid.uuid4().hex}", codec, load_script(args.shaper) or None, args.per_batch or None, seconds(args.interval) if args.interval else None, seconds(args.exit_after) if args.exit_after else None, max_records=args.max_records, max_bytes=args.max_topic_bytes)
            print(*said, sep="\n", end="\n" if said else "")
        case "to-log":
            log.create_missing([args.topic], args.partitions, args.replication)
            n = to_log(Pool.open(spark, f"{args.lake}/{args.pool}"), args.topic, log, codec, load_script(args.shaper) or None)
            print(f"synchronized {plural(n, 'record')} to topic {args.topic!r}" if n else "nothing new found to synchronize")
        case "etl":
            pipeline, said = Pipeline(spark, load(args.file), args.lake), "transform"
            if args.expire:
                n, said = pipeline.expire(offsets(args.expire)), "expire"
            else:
                n = pipeline.run()
            print(f"{said.rstrip('e')}ed {plural(n, 'record')}" if n else f"nothing new found to {said}")
        case "produce":
            log.create_missing([args.topic])
            n = sum(produce(f, log, args.topic, codec) for f in frames_of(spark, args.files))
            print(f"{plural(n, 'message')} produced to topic {args.topic!r}")
        case "consume":
            for f in follow(log, args.topic, args.offset, seconds(args.timeout), codec, meta=args.meta):
                show(f, args.output)
        case "info":
            low, high = log.watermarks(args.topic)
            print(f"low {low} high {high}")
        case "ls":
            for s in codec.registry.subjects():
                r = codec.registry.latest(s)
                print(f"{r.subject} id {r.id} version {r.version}\n{r.schema}")
    return 0


if __name__ == "__main__":
    sys.exit(run())
