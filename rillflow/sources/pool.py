"""Pools: append-only sets of records with atomic commits.

A commit writes Parquet first (a folder for each topic, kind and type, sorted by offset) and then creates the manifest of the next
number, which only one writer can do. A writer whose rows follow from what the pool held says which commit it saw last: if another
came after it, the commit fails, and the writer must look again. Other writers that lose a number try the one after. Readers go by
manifests, so files without one don't exist for them. Manifests keep each part's least and greatest offset, so a scan from an offset
on opens only parts that reach it, and the next offsets of topics need no scan at all. Manifests never change: a pool reads each
once, and a summary that is written every SUMMARY commits stands for all before it.
"""

from __future__ import annotations

import json
import secrets
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.model import DONE, EARLIEST, deref, fuse, type_id
from rillflow.sources import files

SORT_KEY = {"sort_key": "kafka.offset", "order": "asc"}
SUMMARY = 100
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


class PoolError(ValueError):
    pass


class Conflict(PoolError):
    """Another writer committed since the commit that a writer saw last."""


def commit_id() -> str:
    return "".join(secrets.choice(ALPHABET) for _ in range(27))


@dataclass(frozen=True)
class Part:
    topic: str
    kind: str  # data or done
    type_id: str
    schema: str
    path: str
    rows: int
    low: int
    high: int


@dataclass(frozen=True)
class Commit:
    number: int
    id: str
    parts: list[Part]
    source: dict = field(default_factory=dict)
    #: How far the inputs of a transform are finished, by topic: nothing below is pending.
    cursor: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    def text(self) -> str:
        return json.dumps({"number": self.number, "id": self.id, "parts": [p.__dict__ for p in self.parts], "source": self.source, "cursor": self.cursor})

    @classmethod
    def of(cls, raw: dict) -> Commit:
        return cls(raw["number"], raw["id"], [Part(**p) for p in raw["parts"]], raw["source"], raw["cursor"])


class Pool:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: dict[int, Commit] = {}

    @classmethod
    def create(cls, spark: SparkSession, path: str, sort_key: str = "kafka.offset", order: str = "asc") -> Pool:
        files.create(spark, f"{path.rstrip('/')}/_meta.json", json.dumps({"sort_key": sort_key, "order": order}))
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Pool:
        made = cls(spark, path)
        if not files.exists(spark, f"{made.path}/_meta.json"):
            raise PoolError(f"no pool at {path}")
        if json.loads(files.read(spark, f"{made.path}/_meta.json")) != SORT_KEY:
            raise PoolError(f"the key of pool {path} must be kafka.offset in ascending order")
        return made

    # manifests

    def commits(self) -> list[Commit]:
        """All commits so far, in order: a snapshot that later commits don't change."""
        if not self._known and (sums := files.names(self.spark, f"{self.path}/_summaries", ".json")):
            some = [Commit.of(x) for x in json.loads(files.read(self.spark, f"{self.path}/_summaries/{sums[-1]}"))]
            self._known = {c.number: c for c in some}
        for name in files.names(self.spark, f"{self.path}/_commits", ".json"):
            if (number := int(name.removesuffix(".json"))) not in self._known:
                self._known[number] = Commit.of(json.loads(files.read(self.spark, f"{self.path}/_commits/{name}")))
        return [self._known[n] for n in sorted(self._known)]

    def cursors(self, snapshot: list[Commit] | None = None) -> dict[str, int]:
        """How far inputs are finished, by topic, as the last commits that say so do."""
        out: dict[str, int] = {}
        for c in self.commits() if snapshot is None else snapshot:
            for topic, at in c.cursor.items():
                out[topic] = max(out.get(topic, at), at)
        return out

    def parts(self, topic: str | None = None, kind: str = "data", from_offset: int | None = None, snapshot: list[Commit] | None = None) -> list[Part]:
        some = self.commits() if snapshot is None else snapshot
        return [p for c in some for p in c.parts if p.kind == kind and topic in (None, p.topic) and (from_offset is None or p.high >= from_offset)]

    def next_consumer_offset(self, topic: str, snapshot: list[Commit] | None = None) -> int:
        return max((p.high + 1 for p in self.parts(topic, snapshot=snapshot)), default=EARLIEST)

    def next_producer_offsets(self, snapshot: list[Commit] | None = None) -> dict[str, int]:
        out: dict[str, int] = {}
        for p in self.parts(snapshot=snapshot):
            out[p.topic] = max(out.get(p.topic, 0), p.high + 1)
        return out

    # reading

    def by_type(self, topic: str, kind: str = "data", from_offset: int | None = None, snapshot: list[Commit] | None = None) -> dict[str, DataFrame]:
        """A frame for each type that the topic's records have."""
        groups: dict[str, list[Part]] = {}
        for p in self.parts(topic, kind, from_offset, snapshot):
            groups.setdefault(p.type_id, []).append(p)
        out = {}
        for t, some in groups.items():
            df = self.spark.read.schema(T.StructType.fromJson(json.loads(some[0].schema))).parquet(*[f"{self.path}/{p.path}" for p in some])
            out[t] = df if from_offset is None else df.where(F.col("kafka.offset") >= from_offset)
        return out

    def read(self, topic: str, from_offset: int | None = None, snapshot: list[Commit] | None = None, with_type: bool = False) -> DataFrame | None:
        """A topic's records, all types in one shape; None if it has none. Types without records from the offset on shape it too."""
        frames = self.by_type(topic, "data", from_offset, snapshot)
        some = [f.withColumn("type_id", F.lit(t)) if with_type else f for t, f in frames.items()]
        if some and from_offset is not None:
            rest = {p.type_id: p.schema for p in self.parts(topic, snapshot=snapshot) if p.type_id not in frames}
            some += [self.spark.createDataFrame([], T.StructType.fromJson(json.loads(s))) for s in rest.values()]
        return fuse(*some) if some else None

    def done(self, topic: str, snapshot: list[Commit] | None = None, from_offset: int | None = None) -> DataFrame:
        """Completion records of an input topic."""
        frames = list(self.by_type(topic, "done", from_offset, snapshot).values())
        return fuse(*frames) if frames else self.spark.createDataFrame([], DONE)

    # writing

    def commit(self, data: list[tuple[str, DataFrame]], done: list[tuple[str, DataFrame]] = (), source: dict | None = None, after: int | None = None, cursor: dict[str, int] | None = None) -> Commit | None:
        """Adds records of topics and completion records of topics, all or none. Nothing to add makes no commit. A ``source`` that was
        committed before (a batch that is run again) adds nothing. ``after`` is the number of the last commit that the rows follow from (0
        for none): if there is another after it, Conflict is raised and nothing is added."""
        def before() -> Commit | None:
            return next((c for c in self.commits() if c.source == source), None) if source else None

        if again := before():
            return again
        name, parts = commit_id(), []
        for kind, some in (("data", data), ("done", done)):
            for i, (topic, df) in enumerate(some):
                if not isinstance(deref(df.schema, "kafka.offset"), T.LongType):
                    raise PoolError("kafka.offset isn't a long integer")
                of = type_id(df) if kind == "data" else "done"
                place = f"data/commit={name}/{i:04d}-{kind}"
                df.sortWithinPartitions("kafka.offset").write.parquet(f"{self.path}/{place}")
                seen = self.spark.read.schema(df.schema).parquet(f"{self.path}/{place}").agg(F.count("*"), F.min("kafka.offset"), F.max("kafka.offset")).first()
                if seen[0]:
                    parts.append(Part(topic, kind, of, df.schema.json(), place, seen[0], seen[1], seen[2]))
        if not parts:
            return None
        number = max((c.number for c in self.commits()), default=0) if after is None else after
        while True:
            number += 1
            made = Commit(number, name, parts, source or {}, cursor or {})
            try:
                files.create(self.spark, f"{self.path}/_commits/{number:020d}.json", made.text())
            except files.Exists:
                again = before()
                if again or after is not None:
                    files.delete(self.spark, f"{self.path}/data/commit={name}")
                if again:
                    return again
                if after is not None:
                    raise Conflict(f"pool {self.path} has a commit after {after}") from None
                continue
            self._known[number] = made
            if number % SUMMARY == 0:
                self._summarise(number)
            return made

    def _summarise(self, number: int) -> None:
        some = [c for c in self.commits() if c.number <= number]
        try:
            files.create(self.spark, f"{self.path}/_summaries/{number:020d}.json", f"[{', '.join(c.text() for c in some)}]")
        except files.Exists:
            pass  # by another writer, and equal
