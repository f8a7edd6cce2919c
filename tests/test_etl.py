"""The invoice batches end to end, and properties of runs."""

import json

import pytest

from rillflow.config import ConfigError, Rule, Transform, parse, routes
from rillflow.model import EARLIEST
from rillflow.plans.etl import Pipeline, explain, plan
from rillflow.sources.pool import Pool, PoolError

INVOICES = """
inputs:
  - {topic: Invoices, pool: Raw}
  - {topic: InvoiceStatus, pool: Raw}
output: {topic: NewInvoices, pool: Staging}
transforms:
  - type: denorm
    where: value.op IN ('c', 'r')
    left: Invoices
    right: InvoiceStatus
    join-on: left.value.after.ID=right.value.after.InvoiceID
    out: NewInvoices
    select:
      key: left.key
      value.ID: left.value.after.ID
      value.customer: left.value.after.customer
      value.item: left.value.after.item
      value.invoice_status: right.value.after.status
  - type: stateless
    where: value.op = 'u'
    in: InvoiceStatus
    out: NewInvoices
    select:
      key.ID: in.value.after.InvoiceID
      value.ID: in.value.after.InvoiceID
      value.invoice_status: in.value.after.status
  - type: stateless
    where: value.op = 'u'
    in: Invoices
    out: NewInvoices
    select: {key: in.key, value: in.value.after}
  - type: stateless
    where: value.op = 'd'
    in: Invoices
    out: NewInvoices
    select:
      key: in.key
      value: "CAST(NULL AS STRUCT<ID: BIGINT, customer: STRING, item: STRING>)"
"""
INVOICE = "kafka struct<topic: string, offset: bigint>, key struct<ID: bigint>, value struct<op: string, before: struct<ID: bigint, customer: string, item: string>, after: struct<ID: bigint, customer: string, item: string>>"
STATUS = "kafka struct<topic: string, offset: bigint>, key struct<ID: bigint>, value struct<op: string, after: struct<ID: bigint, InvoiceID: bigint, status: string>>"

#: (topic, offset, op, row) of four batches.
BATCHES = [
    [("I", 1, "r", (100, "Alice", "taco")), ("I", 2, "r", (101, "Bob", "burrito")), ("S", 1, "r", (80, 101, "pending")), ("S", 2, "r", (32, 100, "pending"))],
    [("I", 3, "c", (102, "Charlie", "enchilada")), ("I", 4, "c", (103, "Dan", "beans")), ("S", 3, "c", (77, 102, "pending"))],
    [("S", 4, "c", (192, 103, "pending")), ("S", 5, "u", (32, 100, "closed"))],
    [("S", 6, "u", (192, 103, "collections")), ("S", 7, "u", (77, 102, "paid")), ("S", 8, "u", (80, 101, "paid"))],
]
FULL = [(0, 100, "Alice", "taco"), (1, 101, "Bob", "burrito"), (2, 102, "Charlie", "enchilada"), (3, 103, "Dan", "beans")]
PARTIAL = [(4, 100, "closed"), (5, 103, "collections"), (6, 102, "paid"), (7, 101, "paid")]


def load(spark, pool, batch):
    invoices = [(("Invoices", o), (r[0],), (op, None, r)) for t, o, op, r in batch if t == "I"]
    status = [(("InvoiceStatus", o), (r[0],), (op, r)) for t, o, op, r in batch if t == "S"]
    data = [(n, spark.createDataFrame(x, s)) for n, x, s in (("Invoices", invoices, INVOICE), ("InvoiceStatus", status, STATUS)) if x]
    return pool.commit(data)


@pytest.fixture
def lake(spark, tmp_path):
    for name in ("Raw", "Staging"):
        Pool.create(spark, f"{tmp_path}/{name}")
    return str(tmp_path)


def test_batches(spark, lake):
    pipeline = Pipeline(spark, parse(INVOICES), lake)
    raw, staging = pipeline.pools["Raw"], pipeline.pools["Staging"]
    for batch, found, finished in zip(BATCHES, (4, 2, 4, 6), (4, 6, 9, 12), strict=True):
        load(spark, raw, batch)
        assert pipeline.run() == found
        assert sum(staging.done(t).count() for t in ("Invoices", "InvoiceStatus")) == finished
        commits = len(staging.commits())
        assert pipeline.run() == 0 and len(staging.commits()) == commits  # nothing twice
    types = staging.by_type("NewInvoices")
    assert len(types) == 2
    whole = next(f for f in types.values() if "customer" in f.schema["value"].dataType.names)
    part = next(f for f in types.values() if "customer" not in f.schema["value"].dataType.names)
    assert sorted((r.kafka.offset, r.value.ID, r.value.customer, r.value.item) for r in whole.collect()) == FULL
    assert {r.value.invoice_status for r in whole.collect()} == {"pending"}
    assert sorted((r.kafka.offset, r.value.ID, r.value.invoice_status) for r in part.collect()) == PARTIAL
    assert {r.key.ID for r in part.collect()} == {100, 101, 102, 103}
    assert staging.next_producer_offsets() == {"NewInvoices": 8}
    assert all(f.count() == 0 for f in pipeline.pending().values())


def test_done_and_pending_make_up_raw(spark, lake):
    pipeline = Pipeline(spark, parse(INVOICES), lake)
    load(spark, pipeline.pools["Raw"], [x for b in BATCHES[:2] for x in b])
    pipeline.run()
    for topic, n in (("Invoices", 4), ("InvoiceStatus", 3)):
        done = {r.kafka.offset for r in pipeline.pools["Staging"].done(topic).collect()}
        pending = {r.kafka.offset for r in pipeline.pending()[topic].collect()}
        assert len(done | pending) == n and not done & pending
    assert {r.value.after.customer for r in pipeline.pending()["Invoices"].collect()} == {"Dan"}


def test_delete_is_a_typed_null(spark, lake):
    pipeline = Pipeline(spark, parse(INVOICES), lake)
    rows = [(("Invoices", 1), (7,), ("d", (7, "Eve", "soup"), None))]
    pipeline.pools["Raw"].commit([("Invoices", spark.createDataFrame(rows, INVOICE))])
    assert pipeline.run() == 2
    (out,) = pipeline.pools["Staging"].by_type("NewInvoices").values()
    (row,) = out.collect()
    assert row.key.ID == 7 and row.value is None and out.schema["value"].dataType.names == ["ID", "customer", "item"]


def test_stateless_rules_dont_depend_on_batches(spark, tmp_path):
    text = """
inputs: [{topic: A, pool: Raw}]
output: {topic: B, pool: Out}
transforms: [{type: stateless, in: A, out: B, select: {key: in.key, value.x: in.value.x * 2}}]
"""
    rows = [(("A", i), i, (i,)) for i in range(20)]
    schema = "kafka struct<topic: string, offset: bigint>, key bigint, value struct<x: bigint>"
    results = []
    for k, cuts in enumerate(([20], [1, 7, 20])):
        lake = f"{tmp_path}/{k}"
        for n in ("Raw", "Out"):
            Pool.create(spark, f"{lake}/{n}")
        p, last = Pipeline(spark, parse(text), lake), 0
        for c in cuts:
            p.pools["Raw"].commit([("A", spark.createDataFrame(rows[last:c], schema))])
            p.run()
            last = c
        results.append(sorted((r.kafka.offset, r.key, r.value.x) for r in p.pools["Out"].read("B").collect()))
    assert results[0] == results[1] == [(i, i, 2 * i) for i in range(20)]


def test_several_outputs_run(spark, tmp_path):
    rules = [Rule("stateless", o, {"key": "in.key", "value": "in.value"}, in_="A") for o in ("B", "C")]
    from rillflow.config import Route

    t = Transform([Route("A", "P")], [Route("B", "Q"), Route("C", "Q")], rules)
    for n in ("P", "Q"):
        Pool.create(spark, f"{tmp_path}/{n}")
    p = Pipeline(spark, t, str(tmp_path))
    p.pools["P"].commit([("A", spark.createDataFrame([(("A", 0), 1, "x")], "kafka struct<topic: string, offset: bigint>, key int, value string"))])
    assert p.run() >= 2 and p.pools["Q"].read("B").count() == 1


def test_explain():
    text = explain(plan(parse(INVOICES)))
    assert "join Invoices with InvoiceStatus" in text and "case 3" in text


@pytest.mark.parametrize(
    "change, said",
    [
        (("left: Invoices\n", "\n"), "both 'left' and 'right'"),
        (("    left: Invoices\n", "    left: Invoices\n    in: Invoices\n"), "has no 'in'"),
        (("    in: Invoices\n", "\n"), "needs 'in'"),
        (("    in: InvoiceStatus\n", "    in: InvoiceStatus\n    left: Invoices\n"), "has no 'left'"),
        (("type: denorm", "type: other"), "unknown rule type"),
        (("    join-on: left.value.after.ID=right.value.after.InvoiceID\n", "\n"), "join-on"),
        (("=right.value.after.InvoiceID", "=a=b"), "join-on"),
        (("{topic: InvoiceStatus, pool: Raw}", "{topic: Invoices, pool: Raw}"), "routed twice"),
        (("{topic: InvoiceStatus, pool: Raw}", "{topic: Other, pool: Raw}"), "has no pool"),
        (("    select: {key: in.key, value: in.value.after}\n", "\n"), "needs 'select'"),
    ],
)
def test_config_errors(change, said):
    with pytest.raises(ConfigError, match=said):
        parse(INVOICES.replace(*change))


def test_one_input_to_two_pools():
    text = "inputs: [{topic: A, pool: P}]\noutput: [{topic: B, pool: Q}, {topic: C, pool: R}]\ntransforms:\n" + "".join(f"  - {{type: stateless, in: A, out: {o}, select: {{key: in.key}}}}\n" for o in "BC")
    with pytest.raises(ConfigError, match="several pools"):
        parse(text)
    assert routes(parse("inputs: []\n")).pools == {}


def test_pool_key_and_commits(spark, tmp_path):
    with pytest.raises(PoolError, match="must be kafka.offset"):
        Pool.create(spark, f"{tmp_path}/desc", order="desc")
    with pytest.raises(PoolError, match="no pool"):
        Pool.open(spark, f"{tmp_path}/none")
    pool = Pool.create(spark, f"{tmp_path}/p")
    assert pool.next_consumer_offset("A") == EARLIEST and pool.next_producer_offsets() == {}
    schema = "kafka struct<topic: string, offset: bigint>, key int, value string"
    first = pool.commit([("A", spark.createDataFrame([(("A", i), 1, "x") for i in range(5)], schema))], source={"query": "q", "batch": 0})
    assert len(first.id) == 27 and first.rows == 5
    again = pool.commit([("A", spark.createDataFrame([(("A", 0), 1, "x")], schema))], source={"query": "q", "batch": 0})
    assert again.number == first.number and len(pool.commits()) == 1
    assert pool.commit([("A", spark.createDataFrame([], schema))]) is None
    # two writers: the second finds the number taken and goes on to the next
    other = Pool.open(spark, f"{tmp_path}/p")
    pool.commit([("A", spark.createDataFrame([(("A", 5), 1, "x")], schema))])
    other.commit([("A", spark.createDataFrame([(("A", 6), 1, "x")], schema))])
    assert [c.number for c in pool.commits()] == [1, 2, 3] and pool.next_consumer_offset("A") == 7
    assert len(pool.parts("A", from_offset=6)) == 1
    assert json.loads((tmp_path / "p" / "_meta.json").read_text())["sort_key"] == "kafka.offset"
