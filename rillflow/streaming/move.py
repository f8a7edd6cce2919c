"""Logs into pools and pools into logs.

In: a stream of micro-batches, each decoded, checked, shaped and committed once; where to start is what the pools hold, so no consumer
offsets are kept anywhere. Out: batches from the log's head on, so a run that broke off goes on where the log ends.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.codecs import avro_binary, connect_json
from rillflow.codecs.avro_schema import schema_text, subject
from rillflow.codecs.registry import Registry
from rillflow.model import EARLIEST, LATEST, without_meta
from rillflow.operators.records import Shaper, from_offset, shape
from rillflow.sources.pool import Conflict, Pool

FORMATS = ("json", "avro")


class FormatError(ValueError):
    pass


@dataclass
class Codec:
    """How keys and values are written: ``json`` (Connect envelopes) or ``avro`` (framed, with a registry)."""

    format: str = "json"
    registry: Registry = field(default_factory=Registry)
    namespace: str = ""
    tombstones: bool = False

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise FormatError(f"unknown message format {self.format!r}")

    def decode(self, records: DataFrame) -> list[DataFrame]:
        """Record frames (kafka, key, value), one for each pair of schemas."""
        kafka = F.struct("topic", F.col("partition").cast("long").alias("partition"), F.col("offset").cast("long").alias("offset")).alias("kafka")
        df = records.select(kafka, "key", "value")
        if self.format == "json":
            return connect_json.decode_frames(df, ["key", "value"])
        tagged = df.withColumns({f"_{c}": avro_binary.header_id(F.col(c)) for c in ("key", "value")})
        out = []
        for row in tagged.select("_key", "_value").distinct().collect():
            some = tagged.where(F.col("_key").eqNullSafe(F.lit(row[0])) & F.col("_value").eqNullSafe(F.lit(row[1]))).select("kafka", "key", "value")
            schemas = {c: self.registry.schema(i) for c, i in zip(("key", "value"), row, strict=True) if i is not None}
            some = avro_binary.decode_columns(some, schemas) if schemas else some
            for c in ("key", "value"):
                if c not in schemas:
                    some = some.withColumn(c, F.lit(None))
            out.append(some)
        return out

    def encode(self, df: DataFrame) -> DataFrame:
        """key and value as messages. A record without a value field is its own value, and one without a key has none."""
        if "value" not in df.columns:
            rest = [c for c in df.columns if c != "key"]
            df = df.select(*([F.col("key")] if "key" in df.columns else []), F.struct(*rest).alias("value"))
        df = df if "key" in df.columns else df.withColumn("key", F.lit(None))
        if self.format == "json":
            return df.withColumns({c: connect_json.encode(F.col(c), df.schema[c].dataType, df.schema[c].metadata.get("name"), self.tombstones).cast("binary") for c in ("key", "value")})
        ids = {}
        for c in ("key", "value"):
            of = df.schema[c].dataType
            ids[c] = 0 if isinstance(of, T.NullType) else self.registry.register(subject(of, self.namespace), schema_text(of, self.namespace))
        return avro_binary.encode_columns(df, ids)


class OffsetError(ValueError):
    pass


def check_monotonic(records: DataFrame, following: dict[str, int]) -> None:
    """Raises if a topic's records lie before what its pool holds."""
    for row in records.groupBy("topic").agg(F.min("offset").alias("low")).collect():  # a row a topic
        if row.low < following.get(row.topic, 0):
            raise OffsetError(f"topic {row.topic!r}: offset {row.low} comes after {following[row.topic] - 1}")


def starts(pools: dict[str, Pool], topics: dict[str, list[str]]) -> dict[str, int]:
    """Where to read each topic from: the least of what its pools have next."""
    out: dict[str, int] = {}
    for name, some in topics.items():
        for t in some:
            at = pools[name].next_consumer_offset(t)
            out[t] = min(out.get(t, at), at)
    return out


def from_log(log, pools: dict[str, Pool], topics: dict[str, list[str]], checkpoint: str, codec: Codec | None = None, shaper: Shaper | str | None = None, per_batch: int | None = None, interval: float | None = None, exit_after: float | None = None, query: str = "from-log", max_records: int | None = None, max_bytes: int | None = None):
    """Streams topics into pools; ``topics`` has the topics of each pool. Without an interval, what the log holds now is read and the
    stream ends. A batch with more than ``max_records``, or more than ``max_bytes`` of a topic, makes several commits. Returns messages like ``pool X commit Y 2 records`` and the streaming query."""
    codec, said = codec or Codec(), []
    begun = starts(pools, topics)
    stream = log.stream(begun, per_batch)
    session = f"{query}:{sorted(begun.items())}"

    def add(pool: Pool, mine: DataFrame, some: list[str], source: dict):
        """One commit of what the pool lacks of a batch, or None; Conflict if another writer's commit came between."""
        snapshot = pool.commits()
        if any(c.source == source for c in snapshot):
            return None
        data = []
        for t in some:
            at = pool.next_consumer_offset(t, snapshot)
            # a pool that is ahead of others has these already
            fresh = mine.where((F.col("topic") == t) & (F.col("offset") >= max(0, at)))
            if begun[t] in (EARLIEST, at):
                check_monotonic(mine.where(F.col("topic") == t), {t: max(0, at)} if begun[t] != EARLIEST else {})
            if fresh.take(1):
                data += [(t, shape(df, shaper)) for df in codec.decode(fresh)]
        return pool.commit(data, source=source, after=max((c.number for c in snapshot), default=0))

    def commit(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for name, some in topics.items():
                mine = batch.where(F.col("topic").isin(some))
                for i, ranges in enumerate(portions(mine, max_records, max_bytes)):
                    source = {"query": session, "batch": number} | ({"portion": i} if i else {})
                    made = _retried(lambda r=ranges, s=source, n=name, m=mine, x=some: add(pools[n], _within(m, r), x, s))
                    if made:
                        said.append(f"pool {name} commit {made.id} {made.rows} record{'' if made.rows == 1 else 's'}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.queryName(query).foreachBatch(commit).option("checkpointLocation", checkpoint)
    running = (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=f"{interval} seconds")).start()
    if interval is None:
        running.awaitTermination()
    elif exit_after is not None:
        running.awaitTermination(exit_after)
        running.stop()
    return said, running


Range = tuple[str, int, int]
BUCKETS = 4096


def portions(batch: DataFrame, max_records: int | None, max_bytes: int | None) -> list[list[Range] | None]:
    """Ranges of offsets by topic for each commit of a batch, so that none has more records, or more bytes of a topic, than allowed; None
    stands for all. Ranges are made of buckets of offsets, at most BUCKETS of a topic, and one bucket alone may have more bytes."""
    if not max_records and not max_bytes:
        return [None]
    spans = batch.groupBy("topic").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    width = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low") + 1) / BUCKETS))
    width = F.least(width, F.lit(max_records)) if max_records else width
    keyed = batch.join(F.broadcast(spans.select("topic", "low", width.alias("width"))), "topic")
    size = F.coalesce(F.length("key"), F.lit(0)) + F.coalesce(F.length("value"), F.lit(0))
    bucket = keyed.groupBy("topic", "low", "width", F.floor((F.col("offset") - F.col("low")) / F.col("width")).alias("nr")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    out: list[list[Range]] = []
    n, sizes = 0, {}
    for r in bucket.orderBy("topic", "nr").toLocalIterator():
        low = r.low + r.nr * r.width
        full = max_records and n + r.n > max_records or max_bytes and sizes.get(r.topic, 0) + r.bytes > max_bytes
        if not out or full:
            out.append([])
            n, sizes = 0, {}
        n, sizes[r.topic] = n + r.n, sizes.get(r.topic, 0) + r.bytes
        if out[-1] and out[-1][-1][0] == r.topic and out[-1][-1][2] == low:
            out[-1][-1] = (r.topic, out[-1][-1][1], low + r.width)
        else:
            out[-1].append((r.topic, low, low + r.width))
    return out


def _within(batch: DataFrame, ranges: list[Range] | None) -> DataFrame:
    if ranges is None:
        return batch
    some = [(F.col("topic") == t) & (F.col("offset") >= lo) & (F.col("offset") < hi) for t, lo, hi in ranges]
    return batch.where(reduce(Column.__or__, some))


def _retried(step):
    while True:
        try:
            return step()
        except Conflict:
            continue


def to_log(pool: Pool, topic: str, log, codec: Codec | None = None, shaper: Shaper | str | None = None, size: int = 200) -> int:
    """Sends a topic's records to the log, from its head on, in batches; the number sent. The next batch starts after the last record
    read, before shaping, so neither gaps nor a shaper that drops rows stop or repeat anything."""
    codec, sent, at = codec or Codec(), 0, log.head(topic)
    last = pool.next_producer_offsets().get(topic, 0) - 1
    while at <= last:
        some = [f.select("kafka", *[c for c in f.columns if c != "kafka"]) for f in pool.by_type(topic, from_offset=at).values()]
        picks = None
        for f in some:
            offsets = from_offset(f, at).select(F.col("kafka.offset").alias("o"))
            picks = offsets if picks is None else picks.unionByName(offsets)
        upto = [r.o for r in picks.orderBy("o").limit(size).collect()]
        if not upto:
            break
        messages = []
        for f in some:
            shaped = shape(from_offset(f, at, upto[-1]), shaper)
            if "kafka" in shaped.columns:
                shaped = shaped.withColumn("_o", F.col("kafka.offset"))
                order = shaped.select("_o", *[c for c in shaped.columns if c in ("key", "value")] or [c for c in shaped.columns if c not in ("kafka", "_o")])
            else:
                order = shaped.withColumn("_o", F.lit(at))
            keep = order.select("_o", F.struct(*[c for c in order.columns if c != "_o"]).alias("r"))
            wide = keep.select("_o", "r.*")
            coded = _encode_with(wide, codec)
            messages += [(r["_o"], r.key, r.value) for r in coded.collect()]  # at most ``size`` records
        messages.sort(key=lambda m: m[0])
        log.produce(topic, [(None if k is None else bytes(k), None if v is None else bytes(v)) for _, k, v in messages])
        sent += len(messages)
        at = upto[-1] + 1
    return sent


def _encode_with(df: DataFrame, codec: Codec) -> DataFrame:
    """Encodes, keeping _o."""
    if "value" not in df.columns:
        rest = [c for c in df.columns if c not in ("_o", "key")]
        df = df.select("_o", *(["key"] if "key" in df.columns else []), F.struct(*rest).alias("value"))
    return codec.encode(df)


def produce(df: DataFrame, log, topic: str, codec: Codec | None = None) -> int:
    """Sends a frame's records, unsynchronised with anything; how many. Rows come to the driver one partition at a time."""
    coded = (codec or Codec()).encode(df).select("key", "value")
    sent, held = 0, []
    for r in coded.toLocalIterator():
        held.append((None if r.key is None else bytes(r.key), None if r.value is None else bytes(r.value)))
        if len(held) == 10_000:
            log.produce(topic, held)
            sent, held = sent + len(held), []
    if held:
        log.produce(topic, held)
    return sent + len(held)


def follow(log, topic: str, offset: int = EARLIEST, timeout: float = 0.0, codec: Codec | None = None, meta: bool = True, wait: float = 0.1) -> Iterator[DataFrame]:
    """The records from an offset on, decoded, and those that come later, until none has come for ``timeout`` seconds."""
    low, high = log.watermarks(topic)
    at = {EARLIEST: low, LATEST: high}.get(offset, offset)
    until = time.monotonic() + timeout
    while True:
        head = log.head(topic)
        if head > at:
            records = log.read(topic, at).where(F.col("offset") < head)
            frames = (codec or Codec()).decode(records)
            yield from frames if meta else [without_meta(f) for f in frames]
            at, until = head, time.monotonic() + timeout
        elif time.monotonic() >= until:
            return
        else:
            time.sleep(min(wait, max(0.0, until - time.monotonic())))


def consume(log, topic: str, offset: int = EARLIEST, codec: Codec | None = None, meta: bool = True) -> list[DataFrame]:
    """The records there are now from an offset on, decoded, a frame for each pair of schemas."""
    frames = (codec or Codec()).decode(log.read(topic, offset))
    return frames if meta else [without_meta(f) for f in frames]
