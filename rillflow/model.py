"""The data model: envelopes, completion records, and names of dynamic types.

A topic record is ``kafka STRUCT<topic, partition, offset>, key, value``; key and value have any type, and one pool may hold many.
A type has a text and a fingerprint of it (``type_id``), which every stored row carries through the folder that it lies in, so a
field that a row's type lacks stays apart from one that is null.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.LongType()), T.StructField("offset", T.LongType())])
DONE = T.StructType([T.StructField("kafka", T.StructType([T.StructField("topic", T.StringType()), T.StructField("offset", T.LongType())]))])
#: Operation codes of change records; fixed values.
OPS = {"r": "snapshot read", "c": "create", "u": "update", "d": "delete"}
#: Where a consumer starts that has nothing yet, and where one starts that wants only what is new; fixed values.
EARLIEST, LATEST = -2, -1

_NAMES = {
    T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float32", T.DoubleType: "float64",
    T.BooleanType: "bool", T.BinaryType: "bytes", T.StringType: "string", T.TimestampType: "time", T.TimestampNTZType: "time", T.NullType: "null", T.DayTimeIntervalType: "duration",
}


def type_text(of: T.DataType) -> str:
    """A type as text: ``{a:int64,b:[string]}``."""
    if isinstance(of, T.StructType):
        name = lambda x: x if re.fullmatch(r"[A-Za-z_$][A-Za-z0-9_$]*", x) else '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'
        return "{" + ",".join(f"{name(f.name)}:{type_text(f.dataType)}" for f in of.fields) + "}"
    if isinstance(of, T.ArrayType):
        return f"[{type_text(of.elementType)}]"
    if isinstance(of, T.MapType):
        return f"|{{{type_text(of.keyType)}:{type_text(of.valueType)}}}|"
    if isinstance(of, T.DecimalType) and (of.precision, of.scale) == (20, 0):
        return "uint64"
    if type(of) in _NAMES:
        return _NAMES[type(of)]
    return of.simpleString()


def fingerprint(text: str) -> str:
    return hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()


def type_id(df: DataFrame) -> str:
    """That of a record frame's key and value."""
    return fingerprint("".join(f"{c}={type_text(df.schema[c].dataType)};" for c in ("key", "value") if c in df.columns))


def envelope(df: DataFrame, topic: str, offset: str, key: str, value: str, partition: int = 0) -> DataFrame:
    """Records of one topic; offset, key and value are SQL expressions."""
    kafka = F.struct(F.lit(topic).alias("topic"), F.lit(partition).cast("long").alias("partition"), F.expr(offset).cast("long").alias("offset"))
    return df.select(kafka.alias("kafka"), F.expr(key).alias("key"), F.expr(value).alias("value"))


def without_meta(df: DataFrame) -> DataFrame:
    return df.select("key", "value")


def fuse(*frames: DataFrame) -> DataFrame:
    """Frames of several shapes as one table; fields that a shape lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


class FieldError(ValueError):
    pass


def deref(schema: T.StructType, path: str) -> T.DataType:
    """The type at a dotted path, or an error that names what is missing."""
    at: T.DataType = schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.names:
            raise FieldError(f"no field {name!r} of {path!r} in {type_text(schema)}")
        at = at[name].dataType
    return at


def kafka_meta(df: DataFrame) -> DataFrame:
    """The frame, if its records say where they come from (a topic and an integer offset); rows that don't raise an error."""
    if not isinstance(deref(df.schema, "kafka.topic"), T.StringType):
        raise FieldError("kafka.topic isn't a string")
    if not isinstance(deref(df.schema, "kafka.offset"), T.IntegralType):
        raise FieldError("kafka.offset isn't an integer")
    missing = F.raise_error("a record has no kafka.topic or kafka.offset").cast(df.schema["kafka"].dataType)
    return df.withColumn("kafka", F.when(F.col("kafka.topic").isNotNull() & F.col("kafka.offset").isNotNull(), F.col("kafka")).otherwise(missing))
