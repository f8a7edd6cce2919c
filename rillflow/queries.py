"""Queries over the driver's tables, one or more for each operator, with the SQL that gives the same rows.

Tables become topics: ``orders`` (offset o_orderkey, operation by status), ``order_totals`` (line items added up per order) and
``events`` (offset event_id). Orders of the highest priority, and their totals, have completion records already.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow import functions as fn
from rillflow.codecs import avro_binary, connect_json
from rillflow.codecs.avro_schema import schema_text, to_avro
from rillflow.config import Route, Rule, Transform
from rillflow.model import envelope, fingerprint, fuse, type_text
from rillflow.operators import records as R
from rillflow.plans import etl
from rillflow.sources.files import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql if not sql.startswith("...") else BASE + sql[3:]
        return f

    return add


OP = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'd' WHEN o_orderstatus = 'P' THEN 'u' WHEN o_orderstatus = 'F' THEN 'c' ELSE 'r' END"
BASE = f"""WITH RECURSIVE ord AS (SELECT o_orderkey AS off, {OP} AS op, o_custkey AS cust, o_totalprice AS total, o_orderpriority AS pri, o_orderstatus AS status FROM orders),
tot AS (SELECT l_orderkey AS off, CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) AS qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(14, 2))) AS DOUBLE) AS revenue, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
done_o AS (SELECT off FROM ord WHERE pri = '1-URGENT'), done_t AS (SELECT off FROM tot WHERE off IN (SELECT off FROM done_o)),
open_o AS (SELECT * FROM ord WHERE NOT EXISTS (SELECT 1 FROM done_o d WHERE d.off = ord.off)), open_t AS (SELECT * FROM tot WHERE NOT EXISTS (SELECT 1 FROM done_t d WHERE d.off = tot.off)),
facts AS (
  SELECT 0 AS rule, o.off AS src, t.off AS other, o.off AS id, cust, total, qty, revenue, 'orders' AS src_topic FROM open_o o JOIN open_t t ON o.off = t.off WHERE o.op IN ('c', 'r')
  UNION ALL SELECT 1, off, NULL, off, cust, total, NULL, NULL, 'orders' FROM open_o WHERE op = 'u'
  UNION ALL SELECT 2, off, NULL, off, NULL, NULL, NULL, NULL, 'orders' FROM open_o WHERE op = 'd')
"""


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def orders(spark: SparkSession, d: str) -> DataFrame:
    row = "struct(o_custkey as cust, o_totalprice as total, o_orderpriority as pri)"
    return envelope(read(spark, d, "orders"), "orders", "o_orderkey", "struct(o_orderkey as id)", f"struct({OP} as op, if({OP} in ('u', 'd'), {row}, null) as before, if({OP} = 'd', null, {row}) as after)")


def totals(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("qty"), F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double").alias("revenue"), F.count("*").alias("n_lines")
    )
    return envelope(lines, "order_totals", "l_orderkey", "struct(l_orderkey as id)", "struct('c' as op, struct(l_orderkey as order_id, qty, revenue, n_lines) as after)")


def events(spark: SparkSession, d: str) -> DataFrame:
    return envelope(read(spark, d, "events"), "events", "event_id", "struct(user_id)", "struct(event_type as op, struct(ts, value, props) as after)")


def done(records: DataFrame, urgent: DataFrame | None = None) -> DataFrame:
    """Completion records: of urgent orders, or of what belongs to them."""
    mark = F.struct(F.col("kafka.topic").alias("topic"), F.col("kafka.offset").alias("offset")).alias("kafka")
    if urgent is None:
        return records.where("coalesce(value.after.pri, value.before.pri) = '1-URGENT'").select(mark)
    return records.join(urgent.select(F.col("kafka.offset").alias("o")), F.col("kafka.offset") == F.col("o"), "left_semi").select(mark)


def both(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    raw = {"orders": orders(spark, d), "order_totals": totals(spark, d)}
    urgent = done(raw["orders"])
    return raw, {"orders": urgent, "order_totals": done(raw["order_totals"], urgent)}


def transform() -> Transform:
    rules = [
        Rule("denorm", "facts", {"key": "left.key", "value.id": "left.key.id", "value.cust": "left.value.after.cust", "value.total": "left.value.after.total", "value.qty": "right.value.after.qty", "value.revenue": "right.value.after.revenue"}, "value.op IN ('c', 'r')", left="orders", right="order_totals", join_on="left.key.id=right.value.after.order_id"),
        Rule("stateless", "facts", {"key": "in.key", "value.id": "in.key.id", "value.cust": "in.value.after.cust", "value.total": "in.value.after.total"}, "value.op = 'u'", in_="orders"),
        Rule("stateless", "facts", {"key": "in.key", "value": "CAST(NULL AS STRUCT<id: BIGINT, cust: BIGINT, total: DOUBLE>)"}, "value.op = 'd'", in_="orders"),
    ]
    return Transform([Route("orders", "raw"), Route("order_totals", "raw")], [Route("facts", "staging")], rules)


def run(spark: SparkSession, d: str, raw: dict[str, DataFrame] | None = None, marks: dict[str, DataFrame] | None = None) -> etl.Result:
    if raw is None:
        raw, marks = both(spark, d)
    (p,) = etl.plan(transform())
    return etl.run_output(p, raw, marks, 0, keep=stored)


def flat(result: etl.Result) -> DataFrame:
    """Outputs of all rules as plain columns."""
    n = result.numbered
    outs = {c: n.schema[c].dataType for c in n.columns if c.startswith("out")}
    of = lambda path: F.coalesce(*[F.col(f"{c}.{path}") for c, t in outs.items() if path.split(".")[-1] in t[path.split(".")[0]].dataType.names])
    deleted = reduce(Column.__or__, [F.col(f"{c}.value").isNull() & (F.col("_rule") == int(c[3:])) for c in outs])
    return n.select(F.lit("facts").alias("topic"), F.col("_number").alias("off"), F.col("_rule").alias("rule"), of("key.id").alias("id"), deleted.alias("deleted"), *[of(f"value.{c}").alias(c) for c in ("cust", "total", "qty", "revenue")])


# scans, filters and projections


@query("...SELECT 'orders' AS topic, 0 AS part, off, off AS id, op, CASE WHEN op <> 'd' THEN total END AS total FROM ord")
def envelope_scan(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("kafka.topic", F.col("kafka.partition").cast("int").alias("part"), F.col("kafka.offset").alias("off"), "key.id", "value.op", "value.after.total")


@query("...SELECT off, op FROM ord")
def envelope_without_meta(spark: SparkSession, d: str) -> DataFrame:
    from rillflow.model import without_meta

    return without_meta(orders(spark, d)).select(F.col("key.id").alias("off"), "value.op")


@query("SELECT o_orderkey AS off FROM orders WHERE o_orderkey >= 900 AND o_orderkey <= 12000")
def topic_offset_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.from_offset(R.of_topic(orders(spark, d), "orders"), 900, 12000).select(F.col("kafka.offset").alias("off"))


@query("...SELECT off, op FROM ord WHERE op IN ('c', 'r')")
def op_in_filter(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).where("value.op IN ('c', 'r')").select(F.col("kafka.offset").alias("off"), "value.op")


@query("...SELECT off FROM ord WHERE op = 'u' AND NOT total > 100000")
def user_where(spark: SparkSession, d: str) -> DataFrame:
    df = orders(spark, d)
    return df.where(R.user_filter(df, "value.op = 'u' AND NOT value.after.total > 100000")).select(F.col("kafka.offset").alias("off"))


@query("SELECT o_orderkey AS off FROM orders WHERE false")
def where_on_missing_field(spark: SparkSession, d: str) -> DataFrame:
    df = orders(spark, d)
    return df.where(R.user_filter(df, "value.after.no_such_field = 1")).select(F.col("kafka.offset").alias("off"))


@query("SELECT o_orderkey AS off FROM orders WHERE o_orderkey >= 500 ORDER BY 1 LIMIT 200")
def read_batch(spark: SparkSession, d: str) -> DataFrame:
    return R.read_batch(orders(spark, d), "orders", 500, 200).select(F.col("kafka.offset").alias("off"))


@query("SELECT o_orderkey AS id, upper(o_orderpriority) AS pri, len(string_split(o_orderpriority, '-')) AS parts, string_split(o_orderpriority, '-')[1] AS first FROM orders")
def shaper_upper_split(spark: SparkSession, d: str) -> DataFrame:
    fn.register(spark)
    shaped = R.shape(read(spark, d, "orders"), "SELECT o_orderkey AS id, to_upper(o_orderpriority) AS pri, size(split_text(o_orderpriority, '-')) AS parts, o_orderpriority FROM {this}")
    return R.put(shaped, "first", fn.at(fn.split_text(F.col("o_orderpriority"), "-"), 0)).drop("o_orderpriority")


@query("SELECT o_orderkey AS id, 'renamed' AS topic, o_orderkey + 7 AS off FROM orders")
def nested_put(spark: SparkSession, d: str) -> DataFrame:
    df = R.put(R.put(orders(spark, d), "kafka.topic", F.lit("renamed")), "kafka.offset", F.col("kafka.offset") + 7)
    return df.select("key.id", "kafka.topic", F.col("kafka.offset").alias("off"))


@query("...SELECT off AS id, op, cust AS customer FROM ord WHERE op <> 'd'")
def record_literal(spark: SparkSession, d: str) -> DataFrame:
    df = R.wrap(orders(spark, d), "in").where("`in`.value.op <> 'd'")
    made = df.select(*R.project({"out.key.id": "in.key.id", "out.value.op": "in.value.op", "out.value.customer": "in.value.after.cust"}))
    return made.select("out.key.id", "out.value.op", "out.value.customer")


@query("SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 END AS code FROM customer")
def map_lookup(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id"), fn.lookup({"BUILDING": 1, "MACHINERY": 2, "FURNITURE": 3}, F.col("c_mktsegment")).alias("code"))


@query("SELECT s_suppkey AS id, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("nation"))


# joins


@query("...SELECT off FROM open_o")
def anti_join_unprocessed(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    return R.unprocessed(raw["orders"], marks["orders"]).select(F.col("kafka.offset").alias("off"))


@query("...SELECT 'orders' AS topic, off FROM open_o UNION ALL SELECT 'order_totals', off FROM open_t")
def pending_records(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    return fuse(*[R.unprocessed(raw[t], marks[t]).select("kafka.topic", F.col("kafka.offset").alias("off")) for t in raw])


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join_other_key(spark: SparkSession, d: str) -> DataFrame:
    drop = read(spark, d, "orders").where("o_orderstatus = 'F'")
    return R.anti_join(read(spark, d, "customer"), "c_custkey", drop, "o_custkey").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query("SELECT o_orderkey AS seqno FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_join_seqno(spark: SparkSession, d: str) -> DataFrame:
    raw = read(spark, d, "orders").select(F.col("o_orderkey").alias("seqno"))
    staging = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("seqno"))
    return R.anti_join(raw, "seqno", staging, "seqno")


@query("...SELECT src AS id, cust, total, qty, revenue FROM facts WHERE rule = 0")
def denorm_join(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    (p,) = etl.plan(transform())
    left, right = (etl.route(R.unprocessed(raw[t], marks[t]), t, p.rules).where("rule = 0") for t in ("orders", "order_totals"))
    return etl.denorm(p.rules[0], left, right).select("key.id", "value.cust", "value.total", "value.qty", "value.revenue")


@query("...SELECT 'orders' AS topic, src AS off FROM facts UNION ALL SELECT 'order_totals', other FROM facts WHERE rule = 0")
def denorm_markers(spark: SparkSession, d: str) -> DataFrame:
    return fuse(*[df.select("kafka.topic", F.col("kafka.offset").alias("off")) for df in run(spark, d).done.values()])


# aggregations


@query("...SELECT 'orders' AS topic, max(off) + 1 AS next_offset FROM ord UNION ALL SELECT 'order_totals', max(off) + 1 FROM tot UNION ALL SELECT 'events', max(event_id) + 1 FROM events")
def next_producer_offsets(spark: SparkSession, d: str) -> DataFrame:
    raw = fuse(*[t(spark, d).select("kafka") for t in (orders, totals, events)])
    return R.next_producer_offsets(raw)


@query("SELECT 'orders' AS topic, max(o_orderkey) + 1 AS next_offset FROM orders UNION ALL SELECT 'nothing', -2")
def next_consumer_offset(spark: SparkSession, d: str) -> DataFrame:
    df = orders(spark, d)
    return fuse(*[R.next_consumer_offset(df, t).select(F.lit(t).alias("topic"), "next_offset") for t in ("orders", "nothing")])


@query("...SELECT 'orders' AS topic, min(off) AS low, max(off) + 1 AS high FROM ord UNION ALL SELECT 'order_totals', min(off), max(off) + 1 FROM tot")
def offset_range(spark: SparkSession, d: str) -> DataFrame:
    return R.offset_range(fuse(*[t(spark, d).select("kafka") for t in (orders, totals)]))


@query("...SELECT 'orders' AS topic, max(off) AS cursor FROM done_o UNION ALL SELECT 'order_totals', max(off) FROM done_t")
def done_cursor(spark: SparkSession, d: str) -> DataFrame:
    _, marks = both(spark, d)
    kinds = fuse(*marks.values()).withColumn("record_kind", F.lit("done"))
    return kinds.where("record_kind = 'done'").groupBy(F.col("kafka.topic").alias("topic")).agg(F.max("kafka.offset").alias("cursor"))


@query("SELECT event_type AS topic, max(event_id) AS lake_offset, max(user_id) AS kafka_offset FROM events GROUP BY 1")
def multi_max_by_topic(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy(F.col("value.op").alias("topic")).agg(F.max("kafka.offset").alias("lake_offset"), F.max("key.user_id").alias("kafka_offset"))


@query("...SELECT max(off) AS m FROM done_o")
def global_max(spark: SparkSession, d: str) -> DataFrame:
    return both(spark, d)[1]["orders"].agg(F.max("kafka.offset").alias("m"))


@query("...SELECT min(off) - 1 AS cursor FROM open_o")
def contiguous_cursor(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    return R.contiguous_cursor(R.unprocessed(raw["orders"], marks["orders"]), raw["orders"])


@query("""WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p, max(l_linenumber) AS m, bool_or(l_returnflag = 'R') AS done, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey AS txn, n, p[1] AS first_part, p[2] AS second_part FROM l WHERE done""")
def txn_reaggregate(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    found = R.bundles(lines, "l_orderkey", "struct(l_linenumber, l_partkey, l_suppkey)", "l_returnflag = 'R'")
    return found.select(F.col("key").alias("txn"), F.size("records").cast("long").alias("n"), fn.at(F.col("records"), 0).getField("l_partkey").alias("first_part"), fn.at(F.col("records"), 1).getField("l_partkey").alias("second_part"))


@query("""WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p, bool_or(l_returnflag = 'R') AS done, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1)
SELECT l_orderkey AS txn, n, p_retailprice * n AS total FROM l JOIN part ON p_partkey = p[1] WHERE done""")
def txn_incremental(spark: SparkSession, d: str) -> DataFrame:
    finished = read(spark, d, "orders").where("o_orderstatus = 'F'")
    lines = R.anti_join(read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"), "l_orderkey", finished, "o_orderkey")
    found = R.bundles(lines, "l_orderkey", "struct(l_linenumber, l_partkey, l_suppkey)", "l_returnflag = 'R'")
    found = found.select(F.col("key").alias("txn"), F.size("records").cast("long").alias("n"), fn.at(F.col("records"), 0).getField("l_partkey").alias("p"))
    return found.join(read(spark, d, "part"), F.col("p") == F.col("p_partkey")).select("txn", "n", (F.col("p_retailprice") * F.col("n")).alias("total"))


@query("...SELECT 'event' AS kind, count(*) AS n, sum(event_id) AS offsets FROM events UNION ALL SELECT 'order', count(*), sum(off) FROM ord UNION ALL SELECT 'total', count(*), sum(off) FROM tot")
def collect_by_type(spark: SparkSession, d: str) -> DataFrame:
    frames = {"event": events(spark, d), "order": orders(spark, d), "total": totals(spark, d)}
    ids = {fingerprint(type_text(f.schema["value"].dataType)): k for k, f in frames.items()}
    tagged = fuse(*[f.select("kafka.offset", fn.type_fingerprint(f.schema["value"].dataType).alias("type_id")) for f in frames.values()])
    out = tagged.groupBy("type_id").agg(F.count("*").alias("n"), F.sum("offset").alias("offsets"))
    return out.select(fn.lookup(ids, F.col("type_id")).alias("kind"), "n", F.col("offsets").cast("decimal(38,0)").alias("offsets"))


@query("...SELECT op, count(*) AS n FROM ord GROUP BY op HAVING count(*) > 2000")
def having_filter(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).groupBy(F.col("value.op").alias("op")).agg(F.count("*").alias("n")).where("n > 2000")


# order, numbering and branches


@query("...SELECT row_number() OVER (ORDER BY src, src_topic, rule, other) - 1 AS off, src, rule FROM facts")
def assign_output_offsets(spark: SparkSession, d: str) -> DataFrame:
    return flat(run(spark, d)).select("off", F.col("id").alias("src"), "rule")


@query("SELECT event_id AS id, 41 + row_number() OVER (ORDER BY user_id, event_id) AS off FROM events")
def number_in_order(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("user_id", "event_id")
    return R.number(rows, ["user_id", "event_id"], "off", 42, width=16).select(F.col("event_id").alias("id"), "off")


@query("...SELECT max(off) AS last FROM ord")
def tail_one(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).orderBy(F.desc("kafka.offset")).limit(1).select(F.col("kafka.offset").alias("last"))


@query("...SELECT op, min(off) AS off FROM ord GROUP BY op")
def head_per_case(spark: SparkSession, d: str) -> DataFrame:
    return R.first_of_each(orders(spark, d), "value.op", "kafka.offset").select("value.op", F.col("kafka.offset").alias("off"))


@query("...SELECT CASE WHEN op IN ('c', 'r') THEN 0 WHEN op = 'u' AND total > 50000 THEN 1 WHEN op = 'u' THEN 2 END AS rule, count(*) AS n FROM ord GROUP BY 1")
def switch_route_counts(spark: SparkSession, d: str) -> DataFrame:
    df = orders(spark, d)
    cases = [R.user_filter(df, w) for w in ("value.op IN ('c', 'r')", "value.op = 'u' AND value.after.total > 50000", "value.op = 'u'")]
    return df.select(R.switch(cases).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query("...SELECT 'all' AS leg, off FROM ord UNION ALL SELECT 'big', off FROM ord WHERE op <> 'd' AND total > 100000")
def fork_legs(spark: SparkSession, d: str) -> DataFrame:
    df = orders(spark, d)
    return fuse(df.select(F.lit("all").alias("leg"), F.col("kafka.offset").alias("off")), df.where("value.after.total > 100000").select(F.lit("big").alias("leg"), F.col("kafka.offset").alias("off")))


@query("...SELECT 'orders' AS topic, off, CASE WHEN op <> 'd' THEN total END AS total, NULL::DOUBLE AS revenue FROM ord UNION ALL SELECT 'order_totals', off, NULL, revenue FROM tot")
def fuse_shapes(spark: SparkSession, d: str) -> DataFrame:
    one = fuse(orders(spark, d).select("kafka", "value.after"), totals(spark, d).select("kafka", "value.after"))
    return one.select("kafka.topic", F.col("kafka.offset").alias("off"), "after.total", "after.revenue")


# the ETL


@query("...SELECT src AS id, cust, total FROM facts WHERE rule = 1")
def stateless_update(spark: SparkSession, d: str) -> DataFrame:
    return run(spark, d).outputs[1].select("key.id", "value.cust", "value.total")


@query("...SELECT src AS id, true AS deleted FROM facts WHERE rule = 2")
def delete_tombstone(spark: SparkSession, d: str) -> DataFrame:
    return run(spark, d).outputs[2].select("key.id", F.col("value").isNull().alias("deleted"))


@query("...SELECT 'facts' AS topic, row_number() OVER (ORDER BY src, src_topic, rule, other) - 1 AS off, rule, id, rule = 2 AS deleted, cust, total, qty, revenue FROM facts")
def etl_full(spark: SparkSession, d: str) -> DataFrame:
    return flat(run(spark, d))


@query("...SELECT 2 * count(*) AS found FROM facts")
def etl_count(spark: SparkSession, d: str) -> DataFrame:
    return run(spark, d).found


@query("SELECT 0 AS n WHERE false")
def etl_rerun_empty(spark: SparkSession, d: str) -> DataFrame:
    """A second run, with the first one's completions added, has nothing left of what it finished."""
    raw, marks = both(spark, d)
    first = run(spark, d, raw, marks)
    after = {t: marks[t].unionByName(first.done[t]) for t in marks}
    return run(spark, d, raw, after).found.where("found > 0").select(F.lit(0).alias("n"))


@query("...SELECT (SELECT count(*) FROM ord) AS raw, (SELECT count(*) FROM done_o) + (SELECT count(*) FROM facts) AS done, (SELECT count(*) FROM open_o) - (SELECT count(*) FROM facts) AS pending")
def etl_conservation(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    after = marks["orders"].unionByName(run(spark, d, raw, marks).done["orders"])
    counts = [raw["orders"].agg(F.count("*").alias("raw")), after.distinct().agg(F.count("*").alias("done")), R.unprocessed(raw["orders"], after).agg(F.count("*").alias("pending"))]
    return counts[0].join(F.broadcast(counts[1])).join(F.broadcast(counts[2]))  # one row each


# codecs and functions


@query("SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS status, o_totalprice AS total FROM orders")
def connect_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    value = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
    df = read(spark, d, "orders").select(value.alias("v"))
    of = df.schema["v"].dataType
    coded = df.select(connect_json.encode(F.col("v"), of).alias("m"))
    return coded.select(connect_json.decode(F.col("m"), connect_json.type_of(connect_json.schema_of(of))).alias("v")).select("v.*")


@query("""SELECT r_regionkey AS id, '{"schema":{"type":"struct","fields":[{"type":"int32","optional":true,"field":"k"},{"type":"string","optional":true,"field":"n"}],"optional":true},"payload":{"k":' || r_regionkey || ',"n":"' || r_name || '"}}' AS message FROM region""")
def connect_json_text(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "region").select("r_regionkey", F.struct(F.col("r_regionkey").cast("int").alias("k"), F.col("r_name").alias("n")).alias("v"))
    return df.select(F.col("r_regionkey").alias("id"), connect_json.encode(F.col("v"), df.schema["v"].dataType).alias("message"))


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance, s_acctbal < 0 AS owes FROM supplier")
def avro_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    value = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("int").alias("nation"), F.col("s_acctbal").alias("balance"), (F.col("s_acctbal") < 0).alias("owes"))
    df = read(spark, d, "supplier").select(value.alias("v"))
    coded = avro_binary.encode_columns(df, {"v": 7})
    return avro_binary.decode_columns(coded, {"v": to_avro(df.schema["v"].dataType)}).select("v.*")


@query("SELECT n_nationkey AS id, 258 AS schema_id FROM nation")
def avro_header(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "nation").select("n_nationkey", F.struct("n_name").alias("v"))
    coded = avro_binary.encode_columns(df, {"v": 258})
    return coded.select(F.col("n_nationkey").alias("id"), avro_binary.header_id(F.col("v")).alias("schema_id"))


@query("SELECT md5('{}') AS empty, md5('{a:{b:{}}}') AS nested, md5('{a:null}') AS with_null")
def type_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    empty = T.StructType([])
    nested = T.StructType([T.StructField("a", T.StructType([T.StructField("b", empty)]))])
    null = T.StructType([T.StructField("a", T.NullType())])
    return spark.range(1).select(fn.type_fingerprint(empty).alias("empty"), fn.type_fingerprint(nested).alias("nested"), fn.type_fingerprint(null).alias("with_null"))


@query("SELECT r_regionkey AS id, md5('{r_name:string}') AS name FROM region")
def avro_schema_name(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "region")
    of = df.select("r_name").schema
    name = F.get_json_object(F.lit(schema_text(of)), "$.name")
    return df.select(F.col("r_regionkey").alias("id"), F.substring_index(name, "_", -1).alias("name"))


@query("SELECT event_id AS id, epoch_us(ts) AS us FROM events")
def nanos_to_micros(spark: SparkSession, d: str) -> DataFrame:
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 999
    return read(spark, d, "events").select(F.col("event_id").alias("id"), fn.micros(nanos).alias("us"))


@query("SELECT r_regionkey AS id, base64(encode(r_name)) AS b FROM region")
def base64_bytes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.base64(F.col("r_name").cast("binary")).alias("b"))


@query("SELECT c_custkey AS id, CAST(NULL AS BIGINT) AS nothing, 'string' AS kind FROM customer")
def typed_null(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "customer")
    return df.select(F.col("c_custkey").alias("id"), fn.typed_null("bigint").alias("nothing"), fn.type_name(df.schema["c_name"].dataType).alias("kind"))


@query("...SELECT off FROM ord WHERE off > (SELECT min(off) - 1 FROM open_o) AND off <= 14000")
def range_scan_from_cursor(spark: SparkSession, d: str) -> DataFrame:
    raw, marks = both(spark, d)
    cursor = R.contiguous_cursor(R.unprocessed(raw["orders"], marks["orders"]), raw["orders"]).first()[0]
    return R.from_offset(raw["orders"], cursor + 1, 14000).select(F.col("kafka.offset").alias("off"))


@query("SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier")
def concat_sources(spark: SparkSession, d: str) -> DataFrame:
    one = read(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return fuse(one, read(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))


@query("""WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS done FROM lineitem)
SELECT l_orderkey AS txn, pos, l_partkey AS part FROM l WHERE done""")
def bundle_explode(spark: SparkSession, d: str) -> DataFrame:
    """Several outputs of one bundle."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    found = R.bundles(lines, "l_orderkey", "struct(l_linenumber, l_partkey, l_suppkey)", "l_returnflag = 'R'")
    return found.select(F.col("key").alias("txn"), F.posexplode("records").alias("pos", "r")).select("txn", "pos", F.col("r.l_partkey").alias("part"))


@query("...SELECT off, op, CASE op WHEN 'r' THEN 'snapshot read' WHEN 'c' THEN 'create' WHEN 'u' THEN 'update' ELSE 'delete' END AS meaning, op IN ('r', 'c') AS no_before, op = 'd' AS no_after FROM ord")
def debezium_shape(spark: SparkSession, d: str) -> DataFrame:
    from rillflow.model import OPS

    return orders(spark, d).select(F.col("kafka.offset").alias("off"), "value.op", fn.lookup(OPS, F.col("value.op")).alias("meaning"), F.col("value.before").isNull().alias("no_before"), F.col("value.after").isNull().alias("no_after"))


@query("...SELECT off, (SELECT count(*) FROM ord) AS n FROM ord WHERE off < 3")
def checked_kafka_meta(spark: SparkSession, d: str) -> DataFrame:
    from rillflow.model import kafka_meta

    df = kafka_meta(orders(spark, d))
    return df.where("kafka.offset < 3").select(F.col("kafka.offset").alias("off")).join(F.broadcast(df.agg(F.count("*").alias("n"))))  # one row


@query("...SELECT min(off) AS off, 'orders' AS topic, op FROM ord GROUP BY op")
def head_of_each_type(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).groupBy(F.col("kafka.topic").alias("topic"), F.col("value.op").alias("op")).agg(F.min_by("kafka.offset", "kafka.offset").alias("off"))


from rillflow import lake_queries  # noqa: E402, F401  registers more queries here
