"""Scans, filters, projections, aggregations, order and numbering of record frames, as plain DataFrame plans."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.model import EARLIEST

Shaper = Callable[[DataFrame], DataFrame]


# filters


def of_topic(df: DataFrame, topic: str) -> DataFrame:
    return df.where(F.col("kafka.topic") == topic)


def from_offset(df: DataFrame, offset: int, upto: int | None = None) -> DataFrame:
    """Records at or after an offset (and not after another); both bounds reach the scan."""
    out = df.where(F.col("kafka.offset") >= offset)
    return out if upto is None else out.where(F.col("kafka.offset") <= upto)


def user_filter(df: DataFrame, where: str) -> Column:
    """A user's predicate as a truth value that is never null; one that names a field which these records lack is false, and none at
    all is true."""
    if not where.strip():
        return F.lit(True)
    return F.coalesce(F.expr(where).cast("boolean"), F.lit(False)) if names_known(df, where) else F.lit(False)


def lacks_field(e: AnalysisException) -> bool:
    """Whether an expression names a field that the records don't have."""
    return (e.getCondition() or "").split(".")[0] in ("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND", "INVALID_EXTRACT_BASE_FIELD_TYPE")


def names_known(df: DataFrame, where: str) -> bool:
    """Whether these records have all fields that a predicate names."""
    try:
        df.select(F.expr(where).cast("boolean"))
    except AnalysisException as e:
        if lacks_field(e):
            return False
        raise
    return True


# projections


def quote_in(expr: str) -> str:
    """``in.`` at the start of a field path becomes a quoted name, as IN is a keyword."""
    return re.sub(r"(?<![\w.`'])in\.(?=[A-Za-z_`])", "`in`.", expr)


def project(paths: dict[str, str]) -> list[Column]:
    """Columns from a mapping of dotted output paths to SQL expressions, nested records by common prefixes, in the order given."""
    tree: dict = {}
    for path, expr in paths.items():
        at = tree
        *outer, last = path.split(".")
        for name in outer:
            at = at.setdefault(name, {})
            if not isinstance(at, dict):
                raise ValueError(f"{path!r} is inside of what is a value already")
        if last in at:
            raise ValueError(f"{path!r} is given twice")
        at[last] = expr

    def column(x: dict | str) -> Column:
        return F.struct(*[column(v).alias(k) for k, v in x.items()]) if isinstance(x, dict) else F.expr(quote_in(x))

    return [column(v).alias(k) for k, v in tree.items()]


def put(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Adds or overwrites a field, at any depth."""
    first, _, rest = path.partition(".")
    return df.withColumn(first, F.col(first).withField(rest, value) if rest else value)


def wrap(df: DataFrame, name: str) -> DataFrame:
    """Each record as one field of a new one."""
    return df.select(F.struct("*").alias(name))


def shape(df: DataFrame, shaper: Shaper | str | None) -> DataFrame:
    """Through a shaper: a function, or a SQL query over the view ``this``; it may change or drop rows."""
    if shaper is None or shaper == "":
        return df
    return shaper(df) if callable(shaper) else df.sparkSession.sql(shaper, this=df)


# anti joins


def anti_join(df: DataFrame, key: str, drop: DataFrame, drop_key: str) -> DataFrame:
    """Rows whose key isn't among the other's. Null keys never match, and stay. Only the other's key is read."""
    other = drop.select(F.col(drop_key).alias("_drop"))
    return df.join(other, F.col(key) == F.col("_drop"), "left_anti")


def unprocessed(raw: DataFrame, done: DataFrame) -> DataFrame:
    """Records of one topic without a completion record of that topic."""
    return anti_join(raw, "kafka.offset", done, "kafka.offset")


# aggregations


def next_producer_offsets(df: DataFrame) -> DataFrame:
    """topic and next_offset; a topic without records has no row, and starts at 0."""
    return df.groupBy(F.col("kafka.topic").alias("topic")).agg((F.max("kafka.offset") + 1).alias("next_offset"))


def next_consumer_offset(df: DataFrame, topic: str) -> DataFrame:
    """One row: the offset after the last of a topic, or EARLIEST if it has none."""
    return of_topic(df, topic).agg(F.coalesce(F.max("kafka.offset") + 1, F.lit(EARLIEST)).cast("long").alias("next_offset"))


def offset_range(df: DataFrame) -> DataFrame:
    """low and high per topic: the first offset, and the one after the last."""
    return df.groupBy(F.col("kafka.topic").alias("topic")).agg(F.min("kafka.offset").alias("low"), (F.max("kafka.offset") + 1).alias("high"))


def contiguous_cursor(pending: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: the greatest offset with only finished records up to it."""
    first = pending.agg(F.min("kafka.offset").alias("p"))
    last = raw.agg(F.max("kafka.offset").alias("m"))
    return first.join(F.broadcast(last)).select(F.coalesce(F.col("p") - 1, F.col("m")).alias("cursor"))  # one row each


def bundles(df: DataFrame, key: str, order: str, done: str) -> DataFrame:
    """Records of a transaction gathered in order, once one of them says that it is done: columns key and records."""
    row = F.struct(F.expr(order).alias("_order"), F.struct("*").alias("record"))
    grouped = df.groupBy(F.expr(key).alias("key")).agg(F.array_sort(F.collect_list(row)).alias("rows"), F.bool_or(F.expr(done)).alias("done"))
    return grouped.where("done").select("key", F.transform("rows", lambda r: r["record"]).alias("records"))


# order and numbering


def read_batch(df: DataFrame, topic: str, offset: int, size: int, shaper: Shaper | str | None = None) -> DataFrame:
    """The first records of a topic from an offset on, shaped, in order."""
    some = from_offset(of_topic(df, topic), offset).orderBy("kafka.offset").limit(size)
    return shape(some, shaper).orderBy("kafka.offset")


def number(df: DataFrame, order: list[str], into: str, first: Column | int = 0, near: str | None = None, width: int = 1 << 17) -> DataFrame:
    """Numbers rows densely from ``first`` in a total order, without one task that sees them all.

    ``near`` (the first of the order, an integer) cuts rows into buckets of ``width``; rows are numbered within a bucket, and a
    bucket starts where those before it end. The sums over buckets are the only thing in one place.
    """
    near = near or order[0]
    keyed = df.withColumn("_bucket", F.floor(F.col(near) / width))
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.asc_nulls_first("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_first(c) for c in order]))
    numbered = keyed.withColumn("_place", place).join(starts, F.col("_bucket").eqNullSafe(F.col("_b")))
    start = first if isinstance(first, Column) else F.lit(first)
    return numbered.withColumn(into, (start + F.col("_start") + F.col("_place") - 1).cast("long")).drop("_bucket", "_b", "_start", "_place")


# branches


def switch(cases: list[Column]) -> Column:
    """The number of the first case that holds; null if none does."""
    out = F.lit(None).cast("int")
    for i, case in reversed(list(enumerate(cases))):
        out = F.when(case, F.lit(i)).otherwise(out)
    return out


def first_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first record of each key."""
    w = Window.partitionBy(F.expr(key)).orderBy(F.expr(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
