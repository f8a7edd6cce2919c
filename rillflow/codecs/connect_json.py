"""Connect-style JSON envelopes ``{"schema": ..., "payload": ...}`` as column expressions.

Encoding and decoding are to_json and from_json with a schema that is known per type, so they stay in generated code; bytes are base64
text both ways. Times travel as int64 nanoseconds. A null of the null type, or a blank message, is a null message.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CodecError(ValueError):
    pass


#: Names of primitive types in Connect schemas; fixed values.
TO_CONNECT = {
    T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float", T.DoubleType: "double",
    T.BooleanType: "boolean", T.BinaryType: "bytes", T.StringType: "string", T.TimestampType: "int64", T.TimestampNTZType: "int64", T.DayTimeIntervalType: "int64",
}
FROM_CONNECT = {
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "bytes": T.BinaryType(), "string": T.StringType(),
}


def schema_of(of: T.DataType, name: str | None = None, field: str | None = None) -> dict[str, Any]:
    """The Connect schema of a type."""
    out: dict[str, Any] = {}
    if isinstance(of, T.StructType):
        out["type"] = "struct"
        if of.fields:
            out["fields"] = [schema_of(f.dataType, f.metadata.get("name"), f.name) for f in of.fields]
    elif isinstance(of, T.DecimalType) and (of.precision, of.scale) == (20, 0):
        out["type"] = "int64"
    elif type(of) in TO_CONNECT:
        out["type"] = TO_CONNECT[type(of)]
    else:
        raise CodecError(f"Connect has no type for {of.simpleString()}")
    out["optional"] = True
    return out | ({"name": name} if name else {}) | ({"field": field} if field else {})


def type_of(schema: dict[str, Any] | str) -> T.DataType:
    """The type of a Connect schema; names of records are kept as metadata of the fields that hold them."""
    schema = json.loads(schema) if isinstance(schema, str) else schema
    kind = schema.get("type")
    if kind == "struct":
        fields = []
        for f in schema.get("fields") or []:
            meta = {"name": f["name"]} if f.get("name") else None
            fields.append(T.StructField(f["field"], type_of(f), True, meta))
        return T.StructType(fields)
    if kind in FROM_CONNECT:
        return FROM_CONNECT[kind]
    if kind in ("array", "map"):
        raise CodecError(f"{kind} type is not supported")
    raise CodecError(f"unknown Connect type {kind!r}")


def _wire(c: Column, of: T.DataType) -> Column:
    """What stands for a value in the payload."""
    if isinstance(of, T.StructType):
        if not of.fields:
            return c
        made = F.struct(*[_wire(c.getField(f.name), f.dataType).alias(f.name) for f in of.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(of, T.TimestampType):
        return F.unix_micros(c) * 1000
    if isinstance(of, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")) * 1000
    if isinstance(of, T.DayTimeIntervalType):
        return F.unix_micros(F.timestamp_seconds(F.lit(0)) + c) * 1000
    return c


def encode(c: Column, of: T.DataType, name: str | None = None, tombstone: bool = False) -> Column:
    """The message of a value of this type. With ``tombstone``, a null value is a null message and not a null payload."""
    if isinstance(of, T.NullType):
        return F.lit(None).cast("string")
    head = json.dumps({"schema": schema_of(of, name)}, separators=(",", ":"))[:-1] + ',"payload":'
    text = F.to_json(F.struct(_wire(c, of).alias("v")), {"ignoreNullFields": "false"})
    message = F.concat(F.lit(head), F.substring(text, F.lit(6), F.length(text) - 6), F.lit("}"))
    return F.when(c.isNotNull(), message) if tombstone else message


def decode(message: Column, of: T.DataType) -> Column:
    """The value of messages that all have this type's schema."""
    whole = T.StructType([T.StructField("payload", of)])
    blank = F.length(F.trim(F.translate(message, "\n\r\t", "   "))) == 0
    return F.when(message.isNotNull() & ~blank, F.from_json(message, whole, {"mode": "FAILFAST"}).getField("payload"))


def schema_text(message: Column) -> Column:
    """The schema of a message as text; null for a null or blank one."""
    return F.from_json(message, T.StructType([T.StructField("schema", T.StringType())])).getField("schema")


def decode_frames(df: DataFrame, columns: list[str], most_schemas: int = 1000) -> list[DataFrame]:
    """A frame for each combination of schemas that occurs in the columns, with the columns decoded. Only distinct schemas come to the
    driver, and an error is raised if they are more than ``most_schemas``."""
    texts = [schema_text(F.col(c).cast("string")).alias(f"_s{i}") for i, c in enumerate(columns)]
    known = df.select(*texts).distinct().limit(most_schemas + 1).collect()
    if len(known) > most_schemas:
        raise CodecError(f"more than {most_schemas} schemas")
    tagged = df.select("*", *texts)
    out = []
    for row in sorted(known, key=lambda r: tuple(x or "" for x in r)):
        some = tagged
        for i, c in enumerate(columns):
            some = some.where(F.col(f"_s{i}").eqNullSafe(F.lit(row[i])))
            of = type_of(row[i]) if row[i] else None
            value = decode(F.col(c).cast("string"), of) if of is not None else F.lit(None)
            some = some.withColumn(c, value)
        out.append(some.drop(*[f"_s{i}" for i in range(len(columns))]))
    return out
