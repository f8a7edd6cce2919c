"""Exact histogram of encoded lengths and what it answers for every context limit.

Documents are encoded whole and counted per length within each task, so the shuffle carries a row per distinct length
and task. Suffix sums over the histogram give, for a context limit equal to each occurring length, how many documents
reach it and how many tokens are left after truncation; between two occurring lengths that total grows linearly, by
``docs_longer`` a token, so the rows answer every limit. The sums run in two levels (within blocks of lengths, then over
blocks), so no task holds the whole histogram.

Defined cases: a null or empty text has length 0; repeated rows count each; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.store import small_batches, stored
from rillflow.llm.tokens import default_tokenizer, slices, word_tokenizer

BLOCK = 1024


def histogram(docs: DataFrame, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """Columns n_tokens, n_docs."""
    tokenizer = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, found = word_tokenizer(tokenizer).counts, Counter()
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                found.update(counts(texts))
        yield pa.record_batch({"n_tokens": pa.array(list(found), pa.int64()), "n_docs": pa.array(list(found.values()), pa.int64())})

    part = docs.select(F.col(text).cast("string").cast("binary")).mapInArrow(task, "n_tokens long, n_docs long")
    return part.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def limits(lengths: DataFrame) -> DataFrame:
    """From a histogram: docs_at_least, docs_longer, tokens_at_least (of those documents), truncated_total (tokens left when every
    document is cut at n_tokens) and share_at_most (of documents, for quantiles)."""
    lengths, _ = stored(lengths, "lengths")
    lengths = lengths.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / BLOCK).alias("block"), (F.col("n_tokens") * F.col("n_docs")).alias("n_all"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = lengths.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_all").alias("t"))  # a row per 1024 lengths
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"))
    total = lengths.agg(F.sum("n_docs").alias("docs"), F.sum("n_all").alias("tokens"))  # one row
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    out = lengths.withColumns({"d": F.sum("n_docs").over(within), "t": F.sum("n_all").over(within)}).join(blocks, "block").join(F.broadcast(total))
    at_least = F.col("d") + F.col("docs_after")
    tokens = F.col("t") + F.col("tokens_after")
    return out.select(
        "n_tokens", "n_docs", at_least.alias("docs_at_least"), (at_least - F.col("n_docs")).alias("docs_longer"), tokens.alias("tokens_at_least"),
        (F.col("tokens") - tokens + F.col("n_tokens") * at_least).alias("truncated_total"), ((F.col("docs") - at_least + F.col("n_docs")) / F.col("docs")).alias("share_at_most"),
    )


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return limits(histogram(docs, tokenizer))


def truncated_total(rows: DataFrame, limit: int) -> DataFrame:
    """One row: the tokens left under any limit, from the rows of :func:`limits`."""
    return rows.agg(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated_total"))


def quantile(rows: DataFrame, q: float) -> DataFrame:
    """One row: the least length that at least a share ``q`` of documents doesn't exceed."""
    return rows.where(F.col("share_at_most") >= q).agg(F.min("n_tokens").alias("n_tokens"))
