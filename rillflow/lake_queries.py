"""Queries that write pools and topic logs below the shared folder, run transforms and streams between them, and return what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow import functions as fn
from rillflow.config import Route, Rule, Transform
from rillflow.model import envelope, fuse
from rillflow.plans import etl
from rillflow.queries import orders, query, read, totals, transform
from rillflow.sources import files
from rillflow.sources.pool import Conflict, Pool
from rillflow.streaming.log import FileLog
from rillflow.streaming.move import consume, from_log, produce, to_log


def lake(spark: SparkSession, *names: str) -> tuple[str, list[Pool]]:
    folder = files.new_folder(spark, "lake")
    return folder, [Pool.create(spark, f"{folder}/{n}") for n in names]


def below(df: DataFrame, low: int, high: int | None = None) -> DataFrame:
    out = df.where(F.col("kafka.offset") >= low)
    return out if high is None else out.where(F.col("kafka.offset") < high)


# pools


@query("...SELECT off, op FROM ord WHERE off >= 700")
def pool_scan(spark: SparkSession, d: str) -> DataFrame:
    _, (pool,) = lake(spark, "Raw")
    for low, high in ((0, 300), (300, 900), (900, None)):
        pool.commit([("orders", below(orders(spark, d), low, high))])
    return pool.read("orders", 700).select(F.col("kafka.offset").alias("off"), "value.op")


@query("""...SELECT 1 AS number, 'orders' AS topic, count(*) AS n, min(off) AS low, max(off) AS high FROM ord WHERE off < 1000
UNION ALL SELECT 2, 'order_totals', count(*), min(off), max(off) FROM tot WHERE off < 1000
UNION ALL SELECT 3, 'orders', count(*), min(off), max(off) FROM ord WHERE off >= 1000""")
def pool_commit(spark: SparkSession, d: str) -> DataFrame:
    """Two writers; what one plans on an old snapshot isn't committed, and a batch that comes again adds nothing."""
    folder, (one,) = lake(spark, "Raw")
    other = Pool.open(spark, f"{folder}/Raw")
    one.commit([("orders", below(orders(spark, d), 0, 1000))], source={"query": "q", "batch": 0})
    other.commit([("order_totals", below(totals(spark, d), 0, 1000))], after=1)
    try:
        one.commit([("orders", below(orders(spark, d), 0, 1000))], after=1)
    except Conflict:
        one.commit([("orders", below(orders(spark, d), 0, 1000))], source={"query": "q", "batch": 0})
    one.commit([("orders", below(orders(spark, d), 1000))])
    rows = [(c.number, p.topic, p.rows, p.low, p.high) for c in other.commits() for p in c.parts]
    return spark.createDataFrame(rows, "number int, topic string, n long, low long, high long")


@query("SELECT 'customer' AS topic, count(*) AS n, max(c_custkey) + 1 AS next FROM customer UNION ALL SELECT 'supplier', count(*), max(s_suppkey) + 1 FROM supplier")
def pool_types_and_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Topics of different types in one pool; their rows, and the next offsets without a scan."""
    _, (pool,) = lake(spark, "Raw")
    customer = envelope(read(spark, d, "customer"), "customer", "c_custkey", "struct(c_custkey as id)", "struct(c_name as name, c_acctbal as balance)")
    supplier = envelope(read(spark, d, "supplier"), "supplier", "s_suppkey", "struct(s_suppkey as id)", "struct(s_name as name)")
    pool.commit([("customer", customer), ("supplier", supplier)])
    after = spark.createDataFrame(list(pool.next_producer_offsets().items()), "topic string, next long")
    rows = fuse(*[f for t in ("customer", "supplier") for f in pool.by_type(t).values()])
    return rows.groupBy("kafka.topic").agg(F.count("*").alias("n")).join(after, "topic")


# transforms between pools

HALF, FEWER = 600, 400
_TWO_RUNS = f"""...,
made AS (SELECT 0 AS rule, o.off AS src, t.off AS other, o.off <= {HALF} AND t.off <= {FEWER} AS early FROM ord o JOIN tot t ON o.off = t.off WHERE o.op IN ('c', 'r')
  UNION ALL SELECT CASE op WHEN 'u' THEN 1 ELSE 2 END, off, NULL, off <= {HALF} FROM ord WHERE op IN ('u', 'd')),
numbered AS (SELECT src AS id, rule, row_number() OVER (ORDER BY early DESC, src, rule, other) - 1 AS off FROM made)
"""


def two_runs(spark: SparkSession, d: str) -> etl.Pipeline:
    """A transform run after each of two batches; some totals come after their orders."""
    folder, (raw, _) = lake(spark, "raw", "staging")
    pipeline = etl.Pipeline(spark, transform(), folder)
    raw.commit([("orders", below(orders(spark, d), 0, HALF + 1)), ("order_totals", below(totals(spark, d), 0, FEWER + 1))])
    pipeline.run()
    raw.commit([("orders", below(orders(spark, d), HALF + 1)), ("order_totals", below(totals(spark, d), FEWER + 1))])
    pipeline.run()
    return pipeline


@query(_TWO_RUNS + "SELECT off, id, rule = 0 AS joined, rule = 2 AS deleted FROM numbered")
def etl_pipeline_runs(spark: SparkSession, d: str) -> DataFrame:
    pipeline = two_runs(spark, d)
    assert pipeline.run() == 0  # nothing twice
    out = pipeline.pools["staging"].read("facts")
    joined = F.col("value.qty").isNotNull()
    return out.select(F.col("kafka.offset").alias("off"), "key.id", joined.alias("joined"), F.col("value").isNull().alias("deleted"))


@query(_TWO_RUNS + "SELECT 'orders' AS topic, src AS off FROM made UNION ALL SELECT 'order_totals', other FROM made WHERE other IS NOT NULL")
def etl_completions(spark: SparkSession, d: str) -> DataFrame:
    staging = two_runs(spark, d).pools["staging"]
    return fuse(*[staging.done(t) for t in ("orders", "order_totals")]).select("kafka.topic", F.col("kafka.offset").alias("off"))


@query("...SELECT 'orders' AS topic, off FROM ord WHERE op IN ('c', 'r') AND (off % 2 = 1 OR off NOT IN (SELECT off FROM tot)) AND off >= 400 UNION ALL SELECT 'order_totals', off FROM tot WHERE off % 2 = 0 AND off NOT IN (SELECT off FROM ord WHERE op IN ('c', 'r'))")
def etl_expire(spark: SparkSession, d: str) -> DataFrame:
    """Records that are still pending when those of one topic below an offset have been given up."""
    folder, (raw, _) = lake(spark, "raw", "staging")
    pipeline = etl.Pipeline(spark, transform(), folder)
    raw.commit([("orders", orders(spark, d)), ("order_totals", totals(spark, d).where("kafka.offset % 2 = 0"))])
    pipeline.run()
    pipeline.expire({"orders": 400})
    pending = pipeline.pending()
    return fuse(*[f.select("kafka.topic", F.col("kafka.offset").alias("off")) for f in pending.values()])


@query("...SELECT off AS id, total, pri FROM ord WHERE op = 'u'")
def etl_coalesced_updates(spark: SparkSession, d: str) -> DataFrame:
    """Updates of one thing in two topics become one output."""
    def part(name: str, field: str) -> DataFrame:
        rows = orders(spark, d).where("value.op = 'u'")
        return rows.select(F.col("kafka").withField("topic", F.lit(name)).alias("kafka"), "key", F.struct("value.op", F.struct(f"value.after.{field}").alias("after")).alias("value"))

    rule = Rule("denorm", "both", {"key": "left.key", "value.total": "left.value.after.total", "value.pri": "right.value.after.pri"}, "value.op = 'u'", left="prices", right="priorities", join_on="left.key.id = right.key.id")
    folder, (raw, out) = lake(spark, "raw", "out")
    raw.commit([("prices", part("prices", "total")), ("priorities", part("priorities", "pri"))])
    etl.Pipeline(spark, Transform([Route("prices", "raw"), Route("priorities", "raw")], [Route("both", "out")], [rule]), folder).run()
    return out.read("both").select("key.id", "value.total", "value.pri")


# topic logs

_CUSTOMERS = "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS off, c_custkey AS id, c_name AS name FROM customer"


def customers(spark: SparkSession, d: str) -> DataFrame:
    row = F.struct(F.col("c_custkey").alias("id")).alias("key"), F.struct(F.col("c_name").alias("name")).alias("value")
    return read(spark, d, "customer").orderBy("c_custkey").select(*row)


def plain(records: DataFrame) -> DataFrame:
    return records.select(F.col("kafka.offset").alias("off"), "key.id", "value.name")


@query(_CUSTOMERS)
def ingest_resume(spark: SparkSession, d: str) -> DataFrame:
    """A topic into a pool in two runs; the second goes on where the pool ends."""
    folder, (pool,) = lake(spark, "Raw")
    log, rows = FileLog(spark, f"{folder}/log"), customers(spark, d)
    for k, some in enumerate((rows.where("key.id <= 70"), rows.where("key.id > 70"))):
        produce(some, log, "customers")
        from_log(log, {"Raw": pool}, {"Raw": ["customers"]}, f"{folder}/checkpoint{k}", query=f"ingest-{folder[-8:]}-{k}")
    return plain(pool.read("customers"))


@query(f"SELECT CAST(off // 50 + 1 AS INTEGER) AS number, count(*) AS n FROM ({_CUSTOMERS}) WHERE id <= 1000 GROUP BY 1")
def ingest_portions(spark: SparkSession, d: str) -> DataFrame:
    """Commits of at most 50 records."""
    folder, (pool,) = lake(spark, "Raw")
    log = FileLog(spark, f"{folder}/log")
    produce(customers(spark, d).where("key.id <= 1000"), log, "customers")
    from_log(log, {"Raw": pool}, {"Raw": ["customers"]}, f"{folder}/checkpoint", query=f"portions-{folder[-8:]}", max_records=50)
    return spark.createDataFrame([(c.number, c.rows) for c in pool.commits()], "number int, n long")


@query(_CUSTOMERS + " WHERE c_custkey > 3")
def publish_resume(spark: SparkSession, d: str) -> DataFrame:
    """A pool's topic into a log in two runs, and back from there; the second run goes on after the log's last record."""
    folder, (pool,) = lake(spark, "Staging")
    log = FileLog(spark, f"{folder}/log")
    log.create_missing(["customers"])
    place = F.row_number().over(Window.orderBy("key.id")).cast("long") - 1  # a topic to be sent has one order
    rows = customers(spark, d).where("key.id > 3").withColumn("kafka", F.struct(F.lit("customers").alias("topic"), F.lit(0).cast("long").alias("partition"), place.alias("offset")))
    for some in (rows.where("key.id <= 70"), rows.where("key.id > 70")):
        pool.commit([("customers", some.select("kafka", "key", "value"))])
        to_log(pool, "customers", log, size=5000)
    return plain(consume(log, "customers")[0])


@query(f"SELECT * FROM ({_CUSTOMERS}) WHERE off >= 40")
def consume_from_offset(spark: SparkSession, d: str) -> DataFrame:
    log = FileLog(spark, f"{files.new_folder(spark, 'log')}/log")
    produce(customers(spark, d), log, "customers")
    return plain(consume(log, "customers", 40)[0])


# values as text


@query("""SELECT p_partkey AS id, concat_ws('.', 10, p_partkey // 65536 % 256, p_partkey // 256 % 256, p_partkey % 256) || '/24' AS net,
CASE WHEN p_partkey % 65536 = 0 THEN 'fe80::' ELSE 'fe80::' || lower(to_hex(p_partkey % 65536)) END AS ip,
CASE p_size % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large' END AS kind, 'error("' || p_name || '")' AS error FROM part""")
def text_of_values(spark: SparkSession, d: str) -> DataFrame:
    hex_ = lambda of, n: F.lpad(F.hex(of.cast("long")), n, "0")
    part = read(spark, d, "part")
    four = F.unhex(F.concat(F.lit("0A"), hex_(F.col("p_partkey") % (1 << 24), 6)))
    sixteen = F.unhex(F.concat(F.lit("FE80" + "0" * 24), hex_(F.col("p_partkey") % 65536, 4)))
    kind = fn.enum_text(["small", "medium", "large"], F.col("p_size") % 4)
    return part.select(F.col("p_partkey").alias("id"), fn.net_text(four, F.lit(24)).alias("net"), fn.ip_text(sixteen).alias("ip"), kind.alias("kind"), fn.error_text(F.col("p_name")).alias("error"))
