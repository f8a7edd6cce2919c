"""Several writers of one pool or log, cursors, misspelt names, portions, waiting readers, and a broker that isn't one."""

import base64
import io
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage
from test_etl import BATCHES, FULL, INVOICES, load

from rillflow import cli
from rillflow import functions as fn
from rillflow.config import ConfigError, Rule, parse
from rillflow.plans import etl
from rillflow.plans.etl import Pipeline
from rillflow.sources import files, pool
from rillflow.sources.pool import Conflict, Pool
from rillflow.streaming.log import FileLog, KafkaLog, LogError
from rillflow.streaming.move import consume, follow, from_log, portions, produce, to_log

SCHEMA = "kafka struct<topic: string, offset: bigint>, key int, value string"


def some(spark, low, high):
    return [("A", spark.createDataFrame([(("A", i), 1, "x") for i in range(low, high)], SCHEMA))]


def test_two_runs_at_once_have_one_effect(spark, tmp_path):
    """The second run plans before the first commits; it must look again and find nothing left to do."""
    for name in ("Raw", "Staging"):
        Pool.create(spark, f"{tmp_path}/{name}")
    one, two = (Pipeline(spark, parse(INVOICES), str(tmp_path)) for _ in range(2))
    load(spark, one.pools["Raw"], BATCHES[0])
    looked = []

    def first_commits(p):
        if not looked:
            looked.append(p.topic)
            assert one.run() == 4

    two._before_commit = first_commits
    assert two.run() == 0 and looked == ["NewInvoices"]
    staging = Pool.open(spark, f"{tmp_path}/Staging")
    assert len(staging.commits()) == 1 and staging.read("NewInvoices").count() == 2
    # new records come between: the second run's plan is dropped, and the next one makes all of them
    load(spark, one.pools["Raw"], BATCHES[1])
    looked.clear()
    two._before_commit = lambda p: first_commits_with(p, looked, one)
    assert one.run() == 2 and two.run() == 0
    assert sorted(r.kafka.offset for r in staging.read("NewInvoices").collect()) == [0, 1, 2]
    assert len(os.listdir(f"{tmp_path}/Staging/data")) == len(staging.commits()) == 2  # what lost its commit is gone


def first_commits_with(p, looked, one):
    if not looked:
        looked.append(p.topic)
        one.run()


def test_conflicts_and_replays(spark, tmp_path):
    a = Pool.create(spark, f"{tmp_path}/p")
    b = Pool.open(spark, f"{tmp_path}/p")
    a.commit(some(spark, 0, 3), after=0)
    with pytest.raises(Conflict):
        b.commit(some(spark, 0, 3), after=0)
    source = {"query": "q", "batch": 4}
    first = a.commit(some(spark, 3, 5), source=source, after=1)
    assert b.commit(some(spark, 3, 5), source=source, after=1).id == first.id  # the same batch, by another writer
    assert a.read("A").count() == 5 and len(os.listdir(f"{tmp_path}/p/data")) == 2


def test_summaries_stand_for_manifests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pool, "SUMMARY", 3)
    a = Pool.create(spark, f"{tmp_path}/p")
    for i in range(7):
        a.commit(some(spark, i, i + 1))
    assert files.names(spark, f"{tmp_path}/p/_summaries", ".json") == [f"{n:020d}.json" for n in (3, 6)]
    opened = []
    read = files.read
    monkeypatch.setattr(files, "read", lambda s, p: opened.append(p) or read(s, p))
    b = Pool.open(spark, f"{tmp_path}/p")
    assert b.commits() == a.commits() and [p.split("/")[-2] for p in opened] == ["p", "_summaries", "_commits"]
    opened.clear()
    assert len(b.commits()) == 7 and not opened and b.next_consumer_offset("A") == 7


def test_runs_read_from_the_cursor_on(spark, tmp_path, monkeypatch):
    for name in ("Raw", "Staging"):
        Pool.create(spark, f"{tmp_path}/{name}")
    pipeline = Pipeline(spark, parse(INVOICES), str(tmp_path))
    raw, staging = pipeline.pools["Raw"], pipeline.pools["Staging"]
    asked = []
    read = Pool.read
    monkeypatch.setattr(Pool, "read", lambda self, t, at=None, snapshot=None, with_type=False: asked.append((t, at)) or read(self, t, at, snapshot, with_type))
    for batch, want in zip(BATCHES, ({"Invoices": 3, "InvoiceStatus": 3}, {"Invoices": 4, "InvoiceStatus": 4}, {"Invoices": 5, "InvoiceStatus": 6}, {"Invoices": 5, "InvoiceStatus": 9}), strict=True):
        load(spark, raw, batch)
        pipeline.run()
        assert staging.cursors() == want  # Dan's invoice (4) waits for its status in the second batch
        asked.clear()
        assert pipeline.run() == 0 and dict(asked) == want
    assert sorted(r.value.customer for r in staging.read("NewInvoices").where("value.customer is not null").collect()) == sorted(x[2] for x in FULL)


def test_expired_records_hold_the_cursor_no_more(spark, tmp_path):
    for name in ("Raw", "Staging"):
        Pool.create(spark, f"{tmp_path}/{name}")
    pipeline = Pipeline(spark, parse(INVOICES), str(tmp_path))
    load(spark, pipeline.pools["Raw"], BATCHES[0] + BATCHES[1])
    pipeline.run()
    assert pipeline.pools["Staging"].cursors()["Invoices"] == 4
    assert pipeline.expire({"Invoices": 4}) == 0 and pipeline.expire({"Invoices": 5}) == 1 and pipeline.expire({"Invoices": 5}) == 0
    assert pipeline.pools["Staging"].cursors()["Invoices"] == 5 and pipeline.run() == 0


@pytest.mark.parametrize("change", [("value.op = 'd'", "value.opp = 'd'"), ("left.value.after.customer", "left.value.after.custom"), ("left.value.after.ID=", "left.value.after.IDs="), ("in.value.after.status", "in.value.after.state"), ("in.value.after.InvoiceID", "on.value.after.InvoiceID")])
def test_misspelt_names_are_errors(spark, tmp_path, change):
    for name in ("Raw", "Staging"):
        Pool.create(spark, f"{tmp_path}/{name}")
    pipeline = Pipeline(spark, parse(INVOICES.replace(*change, 1)), str(tmp_path))
    assert pipeline.run() == 0  # nothing to hold names against yet
    load(spark, pipeline.pools["Raw"], BATCHES[0])
    with pytest.raises(ConfigError, match="no record of"):
        pipeline.run()


def test_a_field_of_one_type_is_no_error(spark, tmp_path):
    text = "inputs: [{topic: A, pool: P}]\noutput: {topic: B, pool: Q}\ntransforms: [{type: stateless, in: A, out: B, where: value.x > 0, select: {key: in.key, value.x: in.value.x}}]"
    for n in "PQ":
        Pool.create(spark, f"{tmp_path}/{n}")
    p = Pipeline(spark, parse(text), str(tmp_path))
    of = lambda o, f: spark.createDataFrame([(("A", o), 1, (o,))], f"kafka struct<topic: string, offset: bigint>, key int, value struct<{f}: bigint>")
    p.pools["P"].commit([("A", of(1, "x"))])
    p.pools["P"].commit([("A", of(2, "y"))])
    assert p.run() == 2
    p.pools["P"].commit([("A", of(3, "y"))])
    assert p.run() == 0 and {r.kafka.offset for r in p.pending()["A"].collect()} == {2, 3}
    assert etl.plan(parse(text))[0].rules[0] == Rule("stateless", "B", {"key": "in.key", "value.x": "in.value.x"}, "value.x > 0", "A")


# logs


def test_a_writer_that_dies_stops_no_one(spark, tmp_path):
    log, other = FileLog(spark, f"{tmp_path}/log"), FileLog(spark, f"{tmp_path}/log")
    assert log.produce("T", [(b"k", b"v")] * 3) == 0 and other.produce("T", [(None, b"\n")]) == 3 and log.head("T") == 4
    # half a file under another name, as a writer leaves that dies
    (tmp_path / "log/T/00000000000000000004.jsonl.99.part").write_text("{")
    assert other.produce("T", [(b"a", None)]) == 4 and log.produce("T", []) == 5 and log.watermarks("T") == (0, 5)
    with pytest.raises(files.Exists):
        files.create(spark, f"{tmp_path}/log/T/00000000000000000003.jsonl", "")
    assert [r.offset for r in log.read("T", 2).orderBy("offset").collect()] == [2, 3, 4]
    with pytest.raises(LogError):
        log.head("none")


def test_portions(spark):
    rows = [("T", i, b"k", b"v" * (90 if i == 7 else 9)) for i in range(20)] + [("U", 100 + i, None, b"v") for i in range(5)]
    df = spark.createDataFrame(rows, "topic string, offset bigint, key binary, value binary")
    assert portions(df, None, None) == [None]
    got = portions(df, 8, None)
    assert [sum(hi - lo for _, lo, hi in x) for x in got] == [8, 8, 8, 1]
    got = portions(df, None, 50)
    assert [("T", 5, 7) in x for x in got].count(True) == 1 and [("T", 7, 8) in x for x in got].count(True) == 1
    assert sorted(o for x in got for t, lo, hi in x for o in range(lo, hi)) == [*range(20), *range(100, 105)]


def test_ingest_in_portions_and_replays(spark, tmp_path):
    log, target = FileLog(spark, f"{tmp_path}/log"), Pool.create(spark, f"{tmp_path}/P")
    produce(spark.range(25).select(F.struct("id").alias("value")), log, "T")
    from_log(log, {"P": target}, {"P": ["T"]}, f"{tmp_path}/c", max_records=10, query="portioned")
    assert [c.rows for c in target.commits()] == [10, 10, 5] and [c.source.get("portion", 0) for c in target.commits()] == [0, 1, 2]


def test_follow_waits(spark, tmp_path, monkeypatch):
    log = FileLog(spark, f"{tmp_path}/log")
    log.create_missing(["T"])
    assert list(follow(log, "T", timeout=0.05)) == []
    produce(spark.range(3).select(F.struct("id").alias("value")), log, "T")
    late = follow(log, "T", 1, timeout=0.5, wait=0.01)
    assert next(late).count() == 2
    produce(spark.range(1).select(F.struct("id").alias("value")), log, "T")
    assert next(late).count() == 1 and list(late) == []


# a connector of the same options and columns, over a folder


class Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def read(self, partition):
        (topic,) = json.loads(self.options["assign"])
        start = json.loads(self.options["startingoffsets"])[topic]["0"]
        place = os.path.join(self.options["kafka.bootstrap.servers"], topic)
        lines = open(place).read().splitlines() if os.path.exists(place) else []
        for i, line in enumerate(lines):
            if i >= start:
                k, v = json.loads(line)
                yield topic, 0, i, *(None if x is None else base64.b64decode(x) for x in (k, v))


class Writer(DataSourceWriter):
    def __init__(self, options):
        self.options = options

    def write(self, rows):
        text = lambda x: None if x is None else base64.b64encode(bytes(x)).decode()
        with open(os.path.join(self.options["kafka.bootstrap.servers"], self.options["topic"]), "a") as f:
            for r in rows:
                assert r.partition == 0
                f.write(json.dumps([text(r.key), text(r.value)]) + "\n")
        return WriterCommitMessage()


class Broker(DataSource):
    @classmethod
    def name(cls):
        return "folderbroker"

    def schema(self):
        return "topic string, partition int, offset bigint, key binary, value binary"

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options)


class Admin:
    def __init__(self, folder):
        self.folder, self.made = folder, []

    def topics(self):
        return os.listdir(self.folder)

    def create(self, topic, partitions, replication):
        self.made.append((topic, partitions, replication))
        open(os.path.join(self.folder, topic), "w").close()

    def offsets(self, topic):
        return 0, len(open(os.path.join(self.folder, topic)).readlines())


def test_broker(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Broker)
    os.mkdir(f"{tmp_path}/b")
    admin = Admin(f"{tmp_path}/b")
    log = KafkaLog(spark, {"bootstrap_servers": f"{tmp_path}/b"}, admin, "folderbroker")
    log.create_missing(["T"], 1, 3)
    log.create_missing(["T"], 2, 3)
    assert admin.made == [("T", 1, 3)] and log.topics() == ["T"] and log.watermarks("T") == (0, 0)
    with pytest.raises(LogError):
        log.head("none")
    assert produce(spark.range(5).select(F.struct("id").alias("value")), log, "T") == 5 and log.head("T") == 5
    (back,) = consume(log, "T", 2)
    assert sorted(r.value.id for r in back.collect()) == [2, 3, 4]
    # and a pool's records, from the log's head on
    target = Pool.create(spark, f"{tmp_path}/p")
    schema = "kafka struct<topic: string, offset: bigint>, key struct<id: bigint>, value struct<id: bigint>"
    target.commit([("T", spark.createDataFrame([(("T", i), (i,), (i,)) for i in range(8)], schema))])
    assert to_log(target, "T", log, size=2) == 3 and to_log(target, "T", log) == 0 and log.produce("T", []) == 8
    (all_,) = [f for f in follow(log, "T", 5)]
    assert sorted(r.key.id for r in all_.collect()) == [5, 6, 7]


def test_command_line_options(spark, tmp_path, capsys, monkeypatch):
    common = ("--log", f"{tmp_path}/log", "--lake", f"{tmp_path}/lake")
    monkeypatch.setattr("sys.stdin", io.StringIO('{"value": {"a": 1, "b": [1, 2]}}\n\n{"value": {"a": 2, "b": []}}\n'))
    frames = cli.frames_of(spark, ["-"])
    assert frames[0].count() == 2
    (tmp_path / "in.json").write_text('{"key": {"ID": 1}, "value": {"name": "x,y"}}\n')
    assert cli.run(["produce", *common, "--topic", "T", f"{tmp_path}/in.json"], spark) == 0
    assert cli.run(["create", *common, "P"], spark) == 0
    assert cli.run(["from-log", *common, "--pool", "P", "--topic", "T", "--max-records", "10", "--max-topic-bytes", "1000"], spark) == 0
    assert os.listdir(f"{tmp_path}/lake/_checkpoints")
    capsys.readouterr()
    assert cli.run(["consume", *common, "--topic", "T", "--output", "csv", "--timeout", "100ms"], spark) == 0
    assert capsys.readouterr().out == 'key,value\n"{""ID"":1}","{""name"":""x,y""}"\n'
    assert cli.run(["consume", *common, "--topic", "T", "--meta"], spark) == 0
    assert '"offset":0' in capsys.readouterr().out
    (tmp_path / "t.yaml").write_text("inputs: [{topic: T, pool: P}]\noutput: {topic: U, pool: P}\ntransforms: [{type: stateless, in: T, out: U, where: value.name = 'z', select: {key: in.key}}]\n")
    assert cli.run(["etl", *common, "--expire", "T=1", f"{tmp_path}/t.yaml"], spark) == 0
    assert "expired 1 record\n" in capsys.readouterr().out
    assert cli.run(["etl", *common, "--expire", "T", f"{tmp_path}/t.yaml"], spark) == 1
    args = cli.parser().parse_args(["ls", "--registry-url", "http://h:1", "--registry-user", "u"])
    assert type(cli.registry_of(args)).__name__ == "HttpRegistry"
    (tmp_path / "kafka.json").write_text('{"bootstrap_servers": "h:1", "security_protocol": "SASL_SSL", "sasl_mechanisms": "PLAIN"}')
    args = cli.parser().parse_args(["info", "--kafka", f"{tmp_path}/kafka.json", "--topic", "T"])
    assert isinstance(cli.log_of(args, spark), KafkaLog)
    args = cli.parser().parse_args(["to-log", "--pool", "P", "--partitions", "3", "--replication", "2"])
    assert (args.partitions, args.replication) == (3, 2)


# values as text


@pytest.mark.parametrize("address, text", [("0a000001", "10.0.0.1"), ("20010db8000000000000000000000001", "2001:db8::1"), ("0" * 32, "::"), ("0" * 31 + "1", "::1"), ("fe80" + "0" * 28, "fe80::"), ("00010000000000000002000000000000", "1::2:0:0:0"), ("0" * 20 + "ffff01020304", "1.2.3.4"), ("00010000000200000003000000040005", "1:0:2:0:3:0:4:5"), ("0102", None)])
def test_addresses(spark, address, text):
    assert spark.range(1).select(fn.ip_text(F.unhex(F.lit(address))).alias("x")).first().x == text


def test_other_texts(spark):
    row = spark.range(1).select(fn.net_text(F.unhex(F.lit("C0A80000")), F.lit(16)).alias("n"), fn.enum_text(["a", "b"], F.lit(1)).alias("e"), fn.enum_text(["a"], F.lit(1)).alias("f"), fn.error_text(F.lit('no "x"')).alias("g")).first()
    assert tuple(row) == ("192.168.0.0/16", "b", None, 'error("no \\"x\\"")')
