"""The ETL from raw topics to output topics, each input having its effect once.

For an output topic: records of its input topics without a completion record are routed to the first rule whose case holds;
stateless rules map a record, denorm rules join two topics' records. Outputs are numbered from the topic's next offset on, and are
committed together with completion records of what they were made from.

A run reads its inputs and their completion records from a cursor on, below which nothing is pending; a commit says how far it got. (A
topic's offsets only grow from one commit to the next, which ingest checks.) A commit is made after the last commit of the snapshot that the run has seen, so of two runs at once one commits, and the other looks again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.config import ConfigError, Rule, Transform, routes
from rillflow.operators.records import lacks_field, names_known, number, project, quote_in, switch, unprocessed, user_filter
from rillflow.sources.pool import Commit, Conflict, Pool


@dataclass(frozen=True)
class OutputPlan:
    topic: str
    pool: str
    inputs: list[str]
    rules: list[Rule]


def plan(transform: Transform) -> list[OutputPlan]:
    """One plan for each output topic, its rules in the order of the file."""
    r = routes(transform)
    return [OutputPlan(out, r.pools[out], ins, [x for x in transform.rules if x.out == out]) for out, ins in r.inputs_of.items()]


def route(df: DataFrame, topic: str, rules: list[Rule]) -> DataFrame:
    """Adds rule: the number of the first rule whose case holds, or null. A stateless case asks for its topic, a denorm case doesn't, so
    it takes records of other topics out too (they stay pending)."""
    cases: list[Column] = []
    for rule in rules:
        case = user_filter(df, rule.where)
        cases.append(case if rule.type == "denorm" or rule.in_ == topic else F.lit(False))
    return df.withColumn("rule", switch(cases))


def _apply(rule: Rule, df: DataFrame) -> DataFrame:
    """The rule's key and value beside the columns that say where a row comes from."""
    origin = [c for c in df.columns if c.startswith("_")]
    if callable(rule.select):
        out = rule.select(df)
        if not {"key", "value", *origin} <= set(out.columns):
            raise ConfigError("a rule's function must keep columns that start with _ and add key and value")
        return out.select(*origin, "key", "value")
    cols = project(rule.select)
    return df.select(*[F.col(c) for c in origin], *cols)


def stateless(rule: Rule, df: DataFrame) -> DataFrame:
    """Output rows of a stateless rule over its records."""
    record = df.select(F.struct("kafka", "key", "value").alias("in"), F.col("kafka").alias("_left"))
    return _apply(rule, record.withColumn("_right", F.lit(None).cast(df.schema["kafka"].dataType)))


def denorm(rule: Rule, left: DataFrame, right: DataFrame) -> DataFrame:
    """Output rows of a denorm rule: an inner join, so null keys never match."""
    on_left, on_right = rule.sides()
    if on_left.startswith("right") and on_right.startswith("left"):
        on_left, on_right = on_right, on_left
    a = left.select(F.struct("kafka", "key", "value").alias("left"))
    b = right.select(F.struct("kafka", "key", "value").alias("right"))
    joined = a.withColumn("_k", F.expr(on_left)).join(b.withColumn("_j", F.expr(on_right)), F.col("_k") == F.col("_j"), "inner").drop("_k", "_j")
    return _apply(rule, joined.withColumns({"_left": F.col("left.kafka"), "_right": F.col("right.kafka")}))


@dataclass
class Result:
    """outputs: a frame (kafka, key, value) for each rule that made one; done: completion records of each input topic; found: the number
    of rows that outputs and completions were before repeats went, as the run reports it; kept: what is persisted. numbered: all outputs
    in one frame (_rule, _number, _left, _right and a record out<rule> for each rule), which numbers them once."""

    outputs: list[DataFrame]
    numbered: DataFrame
    done: dict[str, DataFrame]
    found: DataFrame
    kept: list[DataFrame]


def run_output(p: OutputPlan, raw: dict[str, DataFrame], done: dict[str, DataFrame], next_offset: int = 0, persist: bool = False, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> Result | None:
    """The lazy plans of one output topic, from the raw records and completion records of its inputs. What several plans read is kept
    by ``persist`` or by ``keep``, a function of a frame and a name; else each of them runs it."""
    routed: dict[str, DataFrame] = {}
    check_fields(p, raw)
    for topic in p.inputs:
        if topic in raw:
            pending = unprocessed(raw[topic], done[topic]) if topic in done else raw[topic]
            routed[topic] = route(pending, topic, p.rules)
            if persist:  # several rules read it, and each would scan and join again
                routed[topic] = routed[topic].persist()
            elif keep:
                routed[topic] = keep(routed[topic], topic)
    legs: list[tuple[int, DataFrame]] = []
    for i, rule in enumerate(p.rules):
        sides = [routed[t].where(F.col("rule") == i) for t in rule.topics if t in routed]
        if len(sides) == len(rule.topics):
            legs.append((i, denorm(rule, *sides) if rule.type == "denorm" else stateless(rule, sides[0])))
    if not legs:
        return None
    one = [leg.select(F.lit(i).alias("_rule"), "_left", "_right", F.struct("key", "value").alias(f"out{i}")) for i, leg in legs]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one)
    if persist:
        rows = rows.persist()
    elif keep:
        rows = keep(rows, p.topic)
    keyed = rows.withColumns({"_offset": F.col("_left.offset"), "_topic": F.col("_left.topic"), "_other": F.col("_right.offset")})
    numbered = number(keyed, ["_offset", "_topic", "_rule", "_other"], "_number", next_offset)
    outputs = []
    for i, _ in legs:
        kafka = F.col("_left").withField("topic", F.lit(p.topic)).withField("offset", F.col("_number"))
        outputs.append(numbered.where(F.col("_rule") == i).select(kafka.alias("kafka"), f"out{i}.key", f"out{i}.value"))
    marks = rows.select(F.explode(F.array("_left", "_right")).alias("k")).where("k is not null").select("k.topic", "k.offset").distinct()
    marks = marks.select(F.struct("topic", "offset").alias("kafka"))
    completions = {t: marks.where(F.col("kafka.topic") == t) for t in p.inputs}
    return Result(outputs, numbered, completions, rows.agg((2 * F.count("*")).alias("found")), [*routed.values(), rows] if persist else [])


def check_fields(p: OutputPlan, raw: dict[str, DataFrame]) -> None:
    """Raises if a rule names a field that no type of its topics' records has: a misspelt name would leave them pending for ever. A rule
    of topics without records yet can't be checked."""
    for i, rule in enumerate(p.rules):
        of = {t: raw[t] for t in rule.topics if t in raw}
        if len(of) < len(rule.topics):
            continue
        if rule.where.strip() and not any(names_known(df, rule.where) for df in of.values()):
            raise ConfigError(f"case {i} of {p.topic}: no record of {', '.join(of)} has the fields of {rule.where!r}")
        sides = [df.select("kafka", "key", "value") for df in of.values()]
        try:
            denorm(rule, sides[0], sides[-1]) if rule.type == "denorm" else stateless(rule, sides[0])
        except AnalysisException as e:
            if lacks_field(e):
                raise ConfigError(f"case {i} of {p.topic}: no record of {', '.join(of)} has a field that 'select' or 'join-on' names: {e.getMessageParameters() or e}") from e
            raise


class Pipeline:
    """A transform between pools in a folder."""

    def __init__(self, spark: SparkSession, transform: Transform, folder: str):
        self.spark, self.plans, self.routes = spark, plan(transform), routes(transform)
        self.pools = {name: Pool.open(spark, f"{folder.rstrip('/')}/{name}") for name in dict.fromkeys(self.routes.pools.values())}

    def _inputs(self, p: OutputPlan, snapshots: dict[str, list[Commit]]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        """Records and completion records of the inputs, from the cursors on."""
        out, raws, done = self.pools[p.pool], {}, {}
        at = out.cursors(snapshots[p.pool])
        for t in p.inputs:
            name = self.routes.pools[t]
            if (df := self.pools[name].read(t, at.get(t), snapshots[name])) is not None:
                raws[t], done[t] = df, out.done(t, snapshots[p.pool], at.get(t))
        return raws, done

    def _cursors(self, raws: dict[str, DataFrame], done: list[dict[str, DataFrame]], snapshots: dict[str, list[Commit]]) -> dict[str, int]:
        """By topic, the first offset that is still pending, or the one after the last."""
        out = {}
        for t, df in raws.items():
            left, name = df.select("kafka"), self.routes.pools[t]
            for some in done:
                left = unprocessed(left, some[t]) if t in some else left
            first = left.agg(F.min("kafka.offset")).first()[0]
            out[t] = self.pools[name].next_consumer_offset(t, snapshots[name]) if first is None else first
        return out

    def _run(self, p: OutputPlan) -> int:
        out = self.pools[p.pool]
        snapshots = {name: pool.commits() for name, pool in self.pools.items()}
        raws, done = self._inputs(p, snapshots)
        last = max((c.number for c in snapshots[p.pool]), default=0)
        made = run_output(p, raws, done, out.next_producer_offsets(snapshots[p.pool]).get(p.topic, 0), persist=True)
        try:
            found = made.found.first()[0] if made else 0
            if found:
                self._before_commit(p)
                out.commit([(p.topic, df) for df in made.outputs], list(made.done.items()), after=last, cursor=self._cursors(raws, [done, made.done], snapshots))
            return found
        finally:
            for df in made.kept if made else []:
                df.unpersist()

    def _before_commit(self, p: OutputPlan) -> None:
        """What tests put between the plan and the commit."""

    def _until_committed(self, step: Callable[[OutputPlan], int], p: OutputPlan) -> int:
        """Others' commits may come between; each round that fails means that another run got on."""
        while True:
            try:
                return step(p)
            except Conflict:
                continue

    def run(self) -> int:
        """Runs every output; the number of output and completion rows that were made (0: nothing new, and no commit)."""
        return sum(self._until_committed(self._run, p) for p in self.plans)

    def expire(self, before: dict[str, int]) -> int:
        """Completes pending records below an offset of their topic without any output, as what would have completed them never came; how
        many. They hold the cursor back no more."""

        def step(p: OutputPlan) -> int:
            out = self.pools[p.pool]
            snapshots = {name: pool.commits() for name, pool in self.pools.items()}
            raws, done = self._inputs(p, snapshots)
            marks = {}
            for t in raws:
                if t in before:
                    old = unprocessed(raws[t], done[t]).where(F.col("kafka.offset") < before[t])
                    marks[t] = old.select(F.struct("kafka.topic", "kafka.offset").alias("kafka"))
            last = max((c.number for c in snapshots[p.pool]), default=0)
            made = out.commit([], list(marks.items()), after=last, cursor=self._cursors(raws, [done, marks], snapshots))
            return made.rows if made else 0

        return sum(self._until_committed(step, p) for p in self.plans)

    def pending(self) -> dict[str, DataFrame]:
        """Records that no completion record accounts for, by input topic."""
        found = {}
        for p in self.plans:
            snapshots = {name: pool.commits() for name, pool in self.pools.items()}
            raws, done = self._inputs(p, snapshots)
            for t in p.inputs:
                name = self.routes.pools[t]
                if t in raws:
                    found[t] = unprocessed(raws[t], done[t])
                elif (df := self.pools[name].read(t, snapshot=snapshots[name])) is not None:
                    found[t] = df.where("false")
        return found


def explain(plans: list[OutputPlan]) -> str:
    """What each output is made of, in words."""
    texts = []
    for p in plans:
        lines = [f"output {p.topic} in pool {p.pool}", f"  unprocessed: {', '.join(p.inputs)} anti join completions on kafka.offset"]
        for i, r in enumerate(p.rules):
            how = f"join {r.left} with {r.right} on {r.join_on}" if r.type == "denorm" else f"map {r.in_}"
            lines.append(f"  case {i}: {quote_in(r.where) or 'true'} => {how}")
            if not callable(r.select):
                lines += [f"    {k} = {v}" for k, v in r.select.items()]
        lines.append("  order by kafka.offset, number, commit with completions")
        texts.append("\n".join(lines))
    return "\n===\n".join(texts)
