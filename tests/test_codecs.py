import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.codecs import avro_binary as ab
from rillflow.codecs import avro_schema as av
from rillflow.codecs import connect_json as cj
from rillflow.codecs.registry import FolderRegistry, Registry, RegistryError
from rillflow.model import fingerprint, type_text

ADDRESS = "struct<id: int, customer_id: int, street: string, city: string, state: string, zip: string, type: string>"
ROW = (10, 1001, "3183 Moore Avenue", "Euless", "Texas", "76036", "SHIPPING")
CASES = [
    ("boolean", True), ("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64), ("float", 32.0), ("double", 64.0), ("binary", bytearray(b"\x01\x23\x45\x67\x89")), ("string", "abcd"),
    ("struct<a: bigint>", (1,)), ("struct<a: bigint>", None), ("struct<a: struct<b: bigint>>", (None,)), ("struct<key: struct<id: int>>", ((10,),)),
    (f"struct<key: struct<id: int>, value: struct<before: {ADDRESS}>>", ((10,), (ROW,))),
    (f"struct<key: struct<id: int>, value: struct<before: {ADDRESS}, after: {ADDRESS}, source: struct<version: string, ts_ms: bigint, row: int, thread: bigint, query: string>, op: string, transaction: struct<id: string, total_order: bigint>>>", ((10,), (None, ROW, ("1.7.2.Final", 1644503374812, 0, None, None), "r", None))),
]


@pytest.mark.parametrize("ddl, value", CASES)
def test_connect_round_trip(spark, ddl, value):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    of = df.schema["v"].dataType
    message = df.select(cj.encode(F.col("v"), of).alias("m")).first().m
    whole = json.loads(message)
    assert set(whole) == {"schema", "payload"} and cj.type_of(whole["schema"]) == of
    coded = spark.createDataFrame([(message,)], "m string")
    assert cj.schema_text(F.col("m")) is not None
    assert json.loads(coded.select(cj.schema_text(F.col("m"))).first()[0]) == whole["schema"]
    back = coded.select(cj.decode(F.col("m"), of).alias("v")).first().v
    assert back == df.first().v


def test_connect_blank_null_and_unknown(spark):
    df = spark.createDataFrame([(None,), ("",), (" \n",)], "m string")
    assert [r.v for r in df.select(cj.decode(F.col("m"), T.LongType()).alias("v")).collect()] == [None] * 3
    assert spark.range(1).select(cj.encode(F.lit(None), T.NullType()).alias("m")).first().m is None
    null = spark.createDataFrame([(None,)], "v struct<a: int>")
    of = null.schema["v"].dataType
    assert json.loads(null.select(cj.encode(F.col("v"), of).alias("m")).first().m)["payload"] is None
    assert null.select(cj.encode(F.col("v"), of, tombstone=True).alias("m")).first().m is None
    for bad in (T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.LongType())):
        with pytest.raises(cj.CodecError):
            cj.schema_of(bad)
    for text in ('{"type": "array"}', '{"type": "odd"}'):
        with pytest.raises(cj.CodecError):
            cj.type_of(text)


def test_connect_names_and_times(spark):
    of = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.LongType())]), True, {"name": "named"})])
    assert cj.schema_of(of, "outer")["name"] == "outer" and cj.type_of(cj.schema_of(of)) == of
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 5),)], "t timestamp_ntz")
    assert json.loads(df.select(cj.encode(F.col("t"), df.schema["t"].dataType).alias("m")).first().m)["payload"] == 1704067201000005000


def test_connect_frames_by_schema(spark):
    frames = [spark.createDataFrame([((1,),)], "v struct<a: bigint>"), spark.createDataFrame([("x",)], "v string")]
    messages = [f.select(F.lit(None).cast("string").alias("key"), cj.encode(F.col("v"), f.schema["v"].dataType).alias("value")) for f in frames]
    got = cj.decode_frames(messages[0].unionByName(messages[1]), ["key", "value"])
    assert sorted(type_text(g.schema["value"].dataType) for g in got) == ["string", "{a:int64}"]
    with pytest.raises(cj.CodecError, match="more than 1"):
        cj.decode_frames(messages[0].unionByName(messages[1]), ["key", "value"], 1)


EMPTY = T.StructType([])


def test_avro_schema_order_names_and_references():
    nested = T.StructType([T.StructField("a", T.StructType([T.StructField("b", EMPTY)]))])
    text = av.schema_text(nested, "namespace")
    whole = json.loads(text)
    assert list(whole) == ["type", "name", "namespace", "doc", "fields"] and list(whole["fields"][0]) == ["name", "type", "default"]
    assert whole["name"].endswith("228c5f7a92fa77715f4dabe46739bfa3") and whole["fields"][0]["type"][1]["name"].endswith("eeb636be88d6a4d3387b3820995db8e7")
    assert whole["fields"][0]["type"][1]["fields"][0]["type"][1]["name"].endswith(fingerprint("{}")) and whole["fields"][0]["type"][1]["fields"][0]["type"][1]["fields"] is None
    assert text.startswith('{\n    "type": "record",\n    "name": "')
    null = av.to_avro(T.StructType([T.StructField("a", T.NullType())]))
    assert null["fields"] == [{"name": "a", "type": "null", "default": None}] and null["name"].endswith("4f5c13d8a692b16d2a7d297f951880a3")
    twice = av.to_avro(T.StructType([T.StructField("a", EMPTY), T.StructField("b", EMPTY)]))
    assert twice["fields"][1]["type"] == ["null", twice["fields"][0]["type"][1]["name"]] and twice["name"].endswith("2d7e63a29282715120ae93531a98c9ef")
    assert av.subject(EMPTY, "n") == f"n.{av.PREFIX}{fingerprint('{}')}"
    with pytest.raises(av.AvroError):
        av.to_avro(T.MapType(T.StringType(), T.StringType()))


def test_avro_types_back():
    of = T.StructType([T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.StructType([T.StructField("c", T.BinaryType())])), T.StructField("d", T.StructType([T.StructField("c", T.BinaryType())])), T.StructField("t", T.TimestampType())])
    assert av.from_avro(av.to_avro(of)) == of
    wide = av.from_avro(["null", "long", "string"])
    assert wide.names == ["tag", "m0", "m1", "m2"]


VALUES = st.fixed_dictionaries(
    {"i": st.integers(-(2**63), 2**63 - 1) | st.none(), "s": st.text(max_size=9) | st.none(), "b": st.binary(max_size=9) | st.none(), "f": st.floats(allow_nan=False) | st.none(), "t": st.booleans() | st.none(), "a": st.lists(st.integers(-(2**31), 2**31) | st.none(), max_size=4).map(lambda x: [y for y in x if y is not None]) | st.none(), "r": st.fixed_dictionaries({"x": st.integers(-9, 9) | st.none()}) | st.none()}
)
SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()), T.StructField("b", T.BinaryType()), T.StructField("f", T.DoubleType()), T.StructField("t", T.BooleanType()), T.StructField("a", T.ArrayType(T.LongType())), T.StructField("r", T.StructType([T.StructField("x", T.LongType())]))])


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_avro_values(value):
    schema = av.to_avro(SCHEMA)
    number, body = ab.split(ab.encode_value(schema, value, 77))
    assert number == 77 and ab.decode_value(schema, body) == value


def test_avro_unions_blocks_and_errors():
    union = ["null", "long", "string"]
    for v in (None, {"tag": 1, "m0": None, "m1": 5, "m2": None}, {"tag": 2, "m0": None, "m1": None, "m2": "x"}):
        assert ab.decode_value(union, ab.split(ab.encode_value(union, v, 1))[1]) == v
    out = bytearray()
    ab.write_long(out, -2)  # a block of two that says its size
    ab.write_long(out, 2)
    out += b"\x02\x04\x00"
    assert ab.decode_value({"type": "array", "items": "long"}, bytes(out)) == [1, 2]
    with pytest.raises(av.AvroError, match="after the value"):
        ab.decode_value("long", b"\x02\x00")
    with pytest.raises(av.AvroError, match="fewer than 5"):
        ab.split(b"\0\0")
    with pytest.raises(av.AvroError, match="not 0"):
        ab.split(b"\1\0\0\0\1")
    with pytest.raises(av.AvroError):
        ab.decode_value("string", b"\x08a")
    assert ab.encode_value(av.to_avro(T.StructType([T.StructField("a", T.NullType())])), {"a": None}, 1)[5:] == b""


def test_avro_columns(spark):
    df = spark.createDataFrame([(1, (2, "x", [1, 2])), (2, None)], "k bigint, v struct<a: bigint, b: string, c: array<bigint>>")
    coded = ab.encode_columns(df, {"v": 3})
    assert coded.select(ab.header_id(F.col("v"))).collect()[0][0] == 3
    assert ab.decode_columns(coded, {"v": av.to_avro(df.schema["v"].dataType)}).collect() == df.collect()


def test_registry(tmp_path):
    for r in (Registry(), FolderRegistry(tmp_path)):
        assert r.register("a", "1") == 1 and r.register("b", "2") == 2 and r.register("a", "2") == 2 and r.register("a", "1") == 1
        assert r.subjects() == ["a", "b"] and r.latest("a").version == 2 and r.schema(1) == "1"
        with pytest.raises(RegistryError):
            r.schema(9)
        with pytest.raises(RegistryError):
            r.latest("c")
    assert FolderRegistry(tmp_path).latest("a").schema == "2"
