"""Avro schemas of Spark types and back.

Each record is named by the fingerprint of its type's text, a repeated record is a reference to its name, fields are unions with null,
and keys stand in the order that Avro's own Java library prints.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

from rillflow.model import fingerprint, type_text


class AvroError(ValueError):
    pass


PREFIX = "rec_"

#: Avro's names of primitive types; fixed values.
TO_AVRO = {
    T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double",
    T.BooleanType: "boolean", T.BinaryType: "bytes", T.StringType: "string", T.NullType: "null",
}
FROM_AVRO = {
    "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "bytes": T.BinaryType(), "string": T.StringType(), "null": T.NullType(),
}
MICROS = {"type": "long", "logicalType": "timestamp-micros"}


def record_name(of: T.StructType, prefix: str = PREFIX) -> str:
    return prefix + fingerprint(type_text(of))


def to_avro(of: T.DataType, namespace: str = "", prefix: str = PREFIX, doc: str = "Created from type", known: set[str] | None = None) -> Any:
    """The schema as a JSON value."""
    known = set() if known is None else known
    if isinstance(of, T.StructType):
        name = record_name(of, prefix)
        if name in known:
            return name
        known.add(name)
        fields = []
        for f in of.fields:
            inner = to_avro(f.dataType, namespace, prefix, doc, known)
            fields.append({"name": f.name, "type": inner if inner == "null" else ["null", inner], "default": None})
        out = {"type": "record", "name": name}
        return out | ({"namespace": namespace} if namespace else {}) | {"doc": f"{doc} {type_text(of)}", "fields": fields or None}
    if isinstance(of, T.ArrayType):
        return {"type": "array", "items": to_avro(of.elementType, namespace, prefix, doc, known)}
    if isinstance(of, (T.TimestampType, T.TimestampNTZType)):
        return dict(MICROS)
    if isinstance(of, T.DayTimeIntervalType) or isinstance(of, T.DecimalType) and (of.precision, of.scale) == (20, 0):
        return "long"
    if type(of) in TO_AVRO:
        return TO_AVRO[type(of)]
    raise AvroError(f"Avro schemas here have no type for {of.simpleString()}")


def schema_text(of: T.DataType, namespace: str = "", **how: str) -> str:
    return json.dumps(to_avro(of, namespace, **how), indent=4)


def subject(of: T.DataType, namespace: str = "", prefix: str = PREFIX) -> str:
    """Where a type's schema is registered: under its record's name, so one topic may have several."""
    name = prefix + fingerprint(type_text(of))
    return f"{namespace}.{name}" if namespace else name


def names_of(schema: Any, found: dict[str, Any] | None = None) -> dict[str, Any]:
    """Named records in a schema, by name and full name."""
    found = {} if found is None else found
    if isinstance(schema, list):
        for x in schema:
            names_of(x, found)
    elif isinstance(schema, dict):
        if schema.get("type") == "record":
            found[schema["name"]] = schema
            if schema.get("namespace"):
                found[f"{schema['namespace']}.{schema['name']}"] = schema
            for f in schema.get("fields") or []:
                names_of(f["type"], found)
        elif schema.get("type") == "array":
            names_of(schema["items"], found)
        elif not isinstance(schema.get("type"), str):
            names_of(schema.get("type"), found)
    return found


def from_avro(schema: Any, names: dict[str, Any] | None = None) -> T.DataType:
    """The type of a schema. A union of null and one type is that type; a wider union is a record of a tag and a field per member."""
    schema = json.loads(schema) if isinstance(schema, str) and schema[:1] in '{["' else schema
    names = names_of(schema) if names is None else names
    if isinstance(schema, list):
        members = [x for x in schema if x != "null"]
        if len(members) == 1:
            return from_avro(members[0], names)
        if not members:
            return T.NullType()
        return T.StructType([T.StructField("tag", T.IntegerType()), *(T.StructField(f"m{i}", from_avro(x, names)) for i, x in enumerate(schema))])
    if isinstance(schema, str):
        if schema in FROM_AVRO:
            return FROM_AVRO[schema]
        if schema in names:
            return from_avro(names[schema], names)
        raise AvroError(f"unknown Avro type {schema!r}")
    kind = schema.get("type")
    if kind == "record":
        return T.StructType([T.StructField(f["name"], from_avro(f["type"], names)) for f in schema.get("fields") or []])
    if kind == "array":
        return T.ArrayType(from_avro(schema["items"], names))
    if kind == "long" and schema.get("logicalType") == "timestamp-micros":
        return T.TimestampType()
    if isinstance(kind, (str, dict, list)):
        return from_avro(kind, names)
    raise AvroError(f"unknown Avro schema {schema!r}")
