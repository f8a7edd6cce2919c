"""A corpus pipeline of four stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row that the one before kept, and returns a DataFrame; all but the last
return the columns of documents. run() writes each result to the shared folder and reads it back for the next.

Defined cases: a null or empty text, or one without letters, goes in the first stage, and would stay in the second (it is like no other
text) and the third (it leaks nothing); in packing it is one end id. A null doc_id, or one that several rows have, doesn't join rows:
stages decide on each row by its own text. Of documents alike, the least id stays, or the first row where a table has such ids;
all documents that are linked, over others as well, are one group, so there are no ties. Very long texts are read whole by each
stage. Repeated rows are exact copies. An empty table stays empty. Columns beyond those of documents are kept, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import decontamination, language_id, ngram_join, packing
from rillflow.llm.joins import without
from rillflow.llm.store import table

NEAR_WORDS, NEAR_PERCENT = 5, 80
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def by_row(stage: Stage) -> Stage:
    """A filtering stage that decides on rows even where ids are null or come more than once: there, rows are numbered, and the
    numbers stand in for the ids."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
        if not ids.where("n > 1 or doc_id is null").take(1):
            return stage(spark, docs, sf_dir)
        kept = "doc_id_"
        while kept in docs.columns:
            kept += "_"
        rows = table(docs.withColumnRenamed("doc_id", kept).withColumn("doc_id", F.monotonically_increasing_id()), "rows")
        return stage(spark, rows, sf_dir).drop("doc_id").withColumnRenamed(kept, "doc_id").select(*docs.columns)

    return run


@by_row
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects: without letters, or like none of the corpus' languages."""
    return without(docs, language_id.identify(docs).where("rejected"))


@by_row
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each component of the Jaccard join over five words at 0.8."""
    return without(docs, ngram_join.join_components(docs, NEAR_WORDS, NEAR_PERCENT).where("doc_id != component_id"))


@by_row
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return without(docs, decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; a row per piece."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express these stages; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
