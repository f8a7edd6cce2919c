"""Connected components of a table of links, by contraction.

Each round, every node takes its least neighbour (or itself) as parent, parents are followed a few steps, and links are
rewritten to parents; a table keeps each node's label. Only aggregations that combine before the shuffle and equi-joins
are used, so a node with very many links is no single task's work, and nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.store import Held, drop, partitions, stored


def components(links: DataFrame) -> DataFrame:
    """``links`` has the columns a and b, of one orderable type. Result: node and label (the component's least node), for every
    node that a link to another node names, as a table. Links to itself, repeated links and nulls change nothing."""
    spark, held, labels, paths = links.sparkSession, Held(), None, []

    def write(df: DataFrame, name: str) -> DataFrame:
        # far fewer bytes than the documents they come from, so fewer files too
        out, path = stored(df.coalesce(max(8, partitions(spark) // 8)), name)
        paths.append(path)
        return out

    edges = write(links.select("a", "b").where("a != b").distinct(), "edges")
    while edges.take(1):
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parents = held.keep(both.groupBy("node").agg(F.min("other").alias("p")).select("node", F.least("node", "p").alias("parent")))
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        for _ in range(2):
            parents = parents.join(up, "parent").select("node", F.col("up").alias("parent"))
        parents = held.keep(parents)
        as_a, as_b = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in "ab")
        before, paths = paths, []
        edges = write(edges.join(as_a, "a").join(as_b, "b").where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if labels is not None:
            to = parents.select(F.col("node").alias("label"), F.col("parent").alias("to"))
            parents = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("parent"))
        labels = write(parents.select("node", F.col("parent").alias("label")), "labels")
        held.release()
        for path in before:
            drop(spark, path)
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("label")).where("false")
    return labels
