"""Joins whose keys may be hot, and anti joins on ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.store import table

HOT_SHARE, BROADCAST_IDS = 1000, 1_000_000


def joined(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row for each key, or nulls. ``counts`` has the rows c of left by key.
    Keys that at least one in ``hot_share`` of the rows has (there can't be more than ``hot_share`` such keys) meet by broadcast, the
    others by a shuffle; rows without a key, if they are as many, aren't moved. An empty left gives no rows."""
    total, most = counts.agg(F.sum("c"), F.max("c")).first()
    if not total or most * hot_share < total:
        return left.join(right, key, "left")
    hot = [r[0] for r in counts.where(F.col("c") * hot_share >= total).select(key).collect()]  # at most hot_share
    kind = left.select(key).schema
    keys = F.broadcast(left.sparkSession.createDataFrame([(k, True) for k in hot if k is not None], kind.add("hot_", "boolean")))
    few, marked = F.broadcast(right.join(keys, key).drop("hot_")), left.join(keys, key, "left")
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    stay = F.col("hot_").isNotNull() | F.col(key).isNull()
    return marked.where(stay).drop("hot_").join(few, key, "left").select(columns).unionByName(marked.where(~stay).drop("hot_").join(right, key, "left").select(columns))


def without(docs: DataFrame, dropped: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """The documents whose id isn't among ``dropped`` (doc_id). Up to ``broadcast_ids`` ids are broadcast; more are joined by a shuffle."""
    ids = table(dropped.select("doc_id").distinct(), "dropped")
    ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
    return docs.join(ids, docs.doc_id.eqNullSafe(ids.doc_id), "left_anti")
