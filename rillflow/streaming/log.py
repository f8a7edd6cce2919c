"""Topic logs.

KafkaLog reads and writes a broker through Spark's connector, if its JAR is there. FileLog keeps a topic as a folder of JSON-lines
files, each a run of consecutive offsets, created so that one of several writers wins; it takes the broker's place where there is none.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.model import EARLIEST, LATEST
from rillflow.sources import files

RECORD = "topic string, partition long, offset long, key binary, value binary"
Message = tuple[bytes | None, bytes | None]


class LogError(LookupError):
    pass


class FileLog:
    """A run of records is one file, named by its first offset and created by one of several writers only; where the last run ends is
    where the log does, so a writer that dies leaves nothing half done."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._lengths: dict[str, int] = {}

    def _place(self, topic: str) -> str:
        return f"{self.folder}/{topic}"

    def create_missing(self, topics: Iterable[str], partitions: int = 1, replication: int = 1) -> None:
        """A topic here has one partition and no replicas, whatever is asked for; what was asked for is noted."""
        for t in topics:
            try:
                files.create(self.spark, f"{self._place(t)}/_topic.json", json.dumps({"partitions": partitions, "replication": replication}))
            except files.Exists:
                pass

    def topics(self) -> list[str]:
        return files.names(self.spark, self.folder)

    def _runs(self, topic: str) -> list[tuple[int, str]]:
        return [(int(x.removesuffix(".jsonl")), x) for x in files.names(self.spark, self._place(topic), ".jsonl")]

    def _end(self, topic: str, run: tuple[int, str]) -> int:
        path = f"{self._place(topic)}/{run[1]}"
        if path not in self._lengths:
            self._lengths[path] = files.read(self.spark, path).count("\n")
        return run[0] + self._lengths[path]

    def watermarks(self, topic: str) -> tuple[int, int]:
        """The first offset, and the one after the last."""
        runs = self._runs(topic)
        if not runs:
            if not files.exists(self.spark, f"{self._place(topic)}/_topic.json"):
                raise LogError(f"no topic {topic!r}")
            return 0, 0
        return runs[0][0], self._end(topic, runs[-1])

    def head(self, topic: str) -> int:
        return self.watermarks(topic)[1]

    def produce(self, topic: str, messages: list[Message]) -> int:
        """Appends messages; the first one's offset."""
        self.create_missing([topic])
        text = lambda x: None if x is None else base64.b64encode(x).decode()
        while True:
            first = self.head(topic)
            if not messages:
                return first
            lines = "".join(json.dumps({"topic": topic, "partition": 0, "offset": first + i, "key": text(k), "value": text(v)}) + "\n" for i, (k, v) in enumerate(messages))
            try:
                files.create(self.spark, f"{self._place(topic)}/{first:020d}.jsonl", lines)
            except files.Exists:
                continue  # another writer was there first
            return first

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select("topic", "partition", "offset", F.unbase64("key").alias("key"), F.unbase64("value").alias("value"))

    _RAW = "topic string, partition long, offset long, key string, value string"

    def read(self, topic: str, offset: int = EARLIEST) -> DataFrame:
        """The records there are now."""
        low, high = self.watermarks(topic)
        start = {EARLIEST: low, LATEST: high}.get(offset, offset)
        all_ = self._runs(topic)
        runs = [x for (_, x), end in zip(all_, [first for first, _ in all_[1:]] + [high], strict=False) if start < end <= high]
        if not runs:
            return self.spark.createDataFrame([], RECORD)
        df = self.spark.read.schema(self._RAW).json([f"{self._place(topic)}/{x}" for x in runs])
        return self._typed(df).where(F.col("offset") >= start)

    def stream(self, topics: dict[str, int], per_batch: int | None = None) -> DataFrame:
        """Records as they come, from an offset on in each topic; ``per_batch`` bounds the runs of a micro-batch."""
        self.create_missing(topics)
        out = None
        for t, offset in topics.items():
            low, high = self.watermarks(t)
            start = {EARLIEST: low, LATEST: high}.get(offset, offset)
            reader = self.spark.readStream.schema(self._RAW).option("pathGlobFilter", "*.jsonl")
            reader = reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader
            one = self._typed(reader.json(self._place(t))).where(F.col("offset") >= start)
            out = one if out is None else out.unionByName(one)
        if out is None:
            raise LogError("no topics")
        return out


#: Security settings of a client and their Spark options; fixed values.
PROTOCOLS = ("PLAINTEXT", "SASL_PLAINTEXT", "SASL_SSL", "SSL")
MECHANISMS = ("PLAIN",)


def kafka_options(settings: dict[str, str]) -> dict[str, str]:
    """Options of Spark's connector from a client's settings; unknown protocols and mechanisms raise an error."""
    out = {"kafka.bootstrap.servers": settings["bootstrap_servers"]}
    protocol, mechanism = settings.get("security_protocol", "PLAINTEXT"), settings.get("sasl_mechanisms", "")
    if protocol not in PROTOCOLS:
        raise ValueError(f"unknown security_protocol {protocol!r}")
    out["kafka.security.protocol"] = protocol
    if protocol.startswith("SASL"):
        if mechanism not in MECHANISMS:
            raise ValueError(f"unknown sasl_mechanisms {mechanism!r}")
        user, password = (settings.get(k, "").replace("\\", "\\\\").replace('"', '\\"') for k in ("sasl_username", "sasl_password"))
        out |= {"kafka.sasl.mechanism": mechanism, "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{user}" password="{password}";'}
    for name, option in (("ssl_ca_location", "kafka.ssl.truststore.location"), ("ssl_keystore_location", "kafka.ssl.keystore.location")):
        if settings.get(name):
            out[option] = settings[name]
    if settings.get("ssl_skip_verify", "").lower() == "true":
        out["kafka.ssl.endpoint.identification.algorithm"] = ""
    return out


class BrokerAdmin:
    """What Spark's connector can't do: topics and their offsets, through the client library that comes with its JAR."""

    def __init__(self, spark: SparkSession, options: dict[str, str]):
        self._jvm, self._settings = spark.sparkContext._jvm, {k.removeprefix("kafka."): v for k, v in options.items() if k.startswith("kafka.")}

    def _client(self):
        properties = self._jvm.java.util.Properties()
        for k, v in self._settings.items():
            properties.put(k, v)
        return self._jvm.org.apache.kafka.clients.admin.Admin.create(properties)

    def topics(self) -> list[str]:
        client = self._client()
        try:
            return sorted(client.listTopics().names().get())
        finally:
            client.close()

    def create(self, topic: str, partitions: int, replication: int) -> None:
        client = self._client()
        try:
            made = self._jvm.org.apache.kafka.clients.admin.NewTopic(topic, partitions, replication)
            client.createTopics(self._jvm.java.util.Collections.singletonList(made)).all().get()
        finally:
            client.close()

    def offsets(self, topic: str) -> tuple[int, int]:
        """The first offset of partition 0, and the one after the last."""
        client, spec = self._client(), self._jvm.org.apache.kafka.clients.admin.OffsetSpec
        try:
            place = self._jvm.org.apache.kafka.common.TopicPartition(topic, 0)
            one = lambda at: client.listOffsets(self._jvm.java.util.Collections.singletonMap(place, at)).partitionResult(place).get().offset()
            return one(spec.earliest()), one(spec.latest())
        finally:
            client.close()


class KafkaLog:
    """Partition 0 of each topic, as order across partitions isn't defined. Needs the connector's JAR, which is missing here: tests put
    another connector and another ``admin`` in its place."""

    def __init__(self, spark: SparkSession, settings: dict[str, str], admin: BrokerAdmin | None = None, connector: str = "kafka"):
        self.spark, self.options, self.connector = spark, kafka_options(settings), connector
        self.admin = admin or BrokerAdmin(spark, self.options)

    def _start(self, topics: dict[str, int]) -> str:
        return json.dumps({t: {"0": o} for t, o in topics.items()})

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.selectExpr("topic", "cast(partition as long) partition", "offset", "key", "value")

    def create_missing(self, topics: Iterable[str], partitions: int = 1, replication: int = 1) -> None:
        known = set(self.admin.topics())
        for t in topics:
            if t not in known:
                self.admin.create(t, partitions, replication)

    def topics(self) -> list[str]:
        return self.admin.topics()

    def stream(self, topics: dict[str, int], per_batch: int | None = None) -> DataFrame:
        """``per_batch`` bounds the records of a micro-batch."""
        reader = self.spark.readStream.format(self.connector).options(**self.options).option("assign", json.dumps({t: [0] for t in topics})).option("startingOffsets", self._start(topics)).option("failOnDataLoss", "true")
        reader = reader.option("maxOffsetsPerTrigger", per_batch) if per_batch else reader
        return self._typed(reader.load())

    def read(self, topic: str, offset: int = EARLIEST) -> DataFrame:
        df = self.spark.read.format(self.connector).options(**self.options).option("assign", json.dumps({topic: [0]})).option("startingOffsets", self._start({topic: offset})).load()
        return self._typed(df)

    def watermarks(self, topic: str) -> tuple[int, int]:
        if topic not in self.admin.topics():
            raise LogError(f"no topic {topic!r}")
        return self.admin.offsets(topic)

    def head(self, topic: str) -> int:
        return self.watermarks(topic)[1]

    def produce(self, topic: str, messages: list[Message]) -> int:
        """Appends messages, in order; the offset that the first one has if nobody else writes to the topic."""
        first = self.head(topic)
        if messages:
            self.produce_frame(topic, self.spark.createDataFrame(messages, "key binary, value binary").coalesce(1))
        return first

    def produce_frame(self, topic: str, df: DataFrame) -> None:
        df.select("key", "value", F.lit(0).alias("partition")).write.format(self.connector).options(**self.options).option("topic", topic).mode("append").save()
