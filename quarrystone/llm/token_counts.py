"""Token counts: an exact length histogram whose suffix sums answer every context limit.

Documents are counted by encoded length (a map-side combined grouping), and suffix
sums over the histogram hold, for each length L, how many documents and tokens lie at
L or above. From them follow totals, quantiles and the tokens left after truncation at
any limit, without touching the documents again. Suffix sums are taken inside blocks
of BLOCK lengths and carried over by block totals, so no task gets the whole histogram.
The counts (a row for each length) are checkpointed, so texts are encoded once.

Defined results: null and empty texts have length 0 and are counted. Repeated rows
count as often as they occur. An empty table gives an empty histogram. Only the text
column is read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from quarrystone.llm._base import checkpointed, table
from quarrystone.llm.tokens import encoder

BLOCK = 64


def lengths(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """One row for each document: n_tokens."""
    make = lambda b, ids, at: pa.RecordBatch.from_arrays([pa.array(np.diff(at), pa.int64())], names=["n_tokens"])
    return df.select(text).mapInArrow(encoder(path, text, make), "n_tokens bigint")


def length_histogram(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """n_tokens, n_docs, and the suffix sums docs_from, tokens_from (documents of that length or longer)."""
    counts = checkpointed(lengths(df, text, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs")))
    counts = counts.withColumns({"tokens": F.col("n_tokens") * F.col("n_docs"), "block": F.floor(F.col("n_tokens") / BLOCK)})
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t"))
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, 0)
    counts = counts.join(blocks, "block")
    return counts.select("n_tokens", "n_docs", (F.sum("n_docs").over(inside) + F.col("d")).alias("docs_from"), (F.sum("tokens").over(inside) + F.col("t")).alias("tokens_from"))


def with_limits(histogram: DataFrame) -> DataFrame:
    """Add what truncation at each length would leave: total tokens, tokens kept, share of documents cut."""
    total = histogram.agg(F.max("docs_from").alias("all_docs"), F.max("tokens_from").alias("all_tokens"))
    longer = F.col("docs_from") - F.col("n_docs")
    kept = F.col("all_tokens") - (F.col("tokens_from") - F.col("n_tokens") * F.col("docs_from"))
    return histogram.crossJoin(F.broadcast(total)).select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", kept.alias("tokens_at_limit"),
        longer.alias("docs_cut"), (1 - longer / F.col("all_docs")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """limit, tokens_at_limit, docs_cut for any limits, also between and beyond observed lengths."""
    spark = histogram.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit bigint")
    h = histogram.select("n_tokens", "n_docs").crossJoin(F.broadcast(asked))
    return h.groupBy("limit").agg(
        F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("tokens_at_limit"), F.coalesce(F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs"))), F.lit(0)).alias("docs_cut")
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length that at least this share of the documents doesn't exceed."""
    spark = histogram.sparkSession
    asked = spark.createDataFrame([(float(x),) for x in shares], "share double")
    return with_limits(histogram).crossJoin(F.broadcast(asked)).filter("quantile >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def query(spark, sf_dir: str) -> DataFrame:
    return with_limits(length_histogram(table(spark, sf_dir, "documents")))
