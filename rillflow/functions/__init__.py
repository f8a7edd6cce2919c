"""Scalar functions that rules and shapers use, on built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.model import fingerprint, type_text


def split_text(c: Column, separator: str) -> Column:
    """Parts of a text between a literal separator."""
    return F.split(c, "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E")


def lookup(table: dict, key: Column) -> Column:
    """The value of a key in a constant map; null if it has none."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def at(c: Column, index: int) -> Column:
    """An array's element, from 0; null beyond its end."""
    return F.get(c, F.lit(index))


def typed_null(of: T.DataType | str) -> Column:
    return F.lit(None).cast(of)


def type_name(of: T.DataType) -> Column:
    return F.lit(type_text(of))


def type_fingerprint(of: T.DataType) -> Column:
    return F.lit(fingerprint(type_text(of)))


def micros(nanos: Column) -> Column:
    """Whole microseconds of nanoseconds, towards zero."""
    return F.call_function("div", nanos, F.lit(1000)).cast("long")


def any_true(c: Column) -> Column:
    return F.bool_or(c)


def register(spark: SparkSession) -> None:
    """The functions that SQL texts may call by name, as SQL functions (no Python runs)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION split_text(s STRING, sep STRING) RETURNS ARRAY<STRING> RETURN split(s, concat('\\\\Q', sep, '\\\\E'))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION to_upper(s STRING) RETURNS STRING RETURN upper(s)")


# values of types that messages carry as text


def ip_text(address: Column) -> Column:
    """An address of 4 or 16 bytes as text: dotted decimals, or hexadecimal groups of which the first longest run of two or more zeros is
    left out; null for other lengths. A 16-byte address that stands for one of 4 bytes is written like that one."""
    text = F.hex(address)
    number = lambda at, n: F.conv(F.substring(text, at, n), 16, 10)
    four = lambda at: F.concat_ws(".", *[number(at + 2 * k, 2) for k in range(4)])
    whole = F.lower(F.concat_ws(":", *[F.conv(F.substring(text, 4 * k + 1, 4), 16, 16) for k in range(8)]))
    short = whole
    for n in range(2, 9):  # longer runs are tried first, as they are put on last
        run = "0" + ":0" * (n - 1)
        short = F.when(whole.rlike(f"(^|:){run}(:|$)"), F.regexp_replace(whole, f"^(|.*?:){run}(?::|$)", "$1:")).otherwise(short)
    short = F.when(short == ":", "::").when(short.startswith(":") & ~short.startswith("::"), F.concat(F.lit(":"), short)).otherwise(short)
    return F.when(F.length(address) == 4, four(1)).when((F.length(address) == 16) & text.startswith("0" * 20 + "FFFF"), four(25)).when(F.length(address) == 16, short)


def net_text(address: Column, bits: Column) -> Column:
    """An address range: the address and the length of its mask."""
    return F.concat(ip_text(address), F.lit("/"), bits.cast("string"))


def enum_text(symbols: list[str], index: Column) -> Column:
    """The name of an enumeration's value; null beyond its names."""
    return F.get(F.array(*[F.lit(s) for s in symbols]), index.cast("int"))


def error_text(message: Column) -> Column:
    """An error value as text: its message, quoted."""
    quoted = F.to_json(F.struct(message.alias("m")))
    return F.concat(F.lit("error("), F.substring(quoted, F.lit(6), F.length(quoted) - 6), F.lit(")"))
