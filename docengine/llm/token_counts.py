"""Exact histogram of encoded lengths, and what its suffix sums answer.

Batches count their own lengths, so the shuffle carries one row per batch and
length.  Documents at least as long, their tokens, and the total that a
context limit leaves are suffix sums over the lengths; they are taken in two
levels (within a range of lengths, and over the ranges), so that no task holds
the whole histogram however long texts become.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, prepare
from docengine.llm.tokens import encoded

RANGE = 1024
_COUNTS = pa.schema([("length", pa.int64()), ("n_docs", pa.int64())])


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(length, n_docs): documents by the number of tokens of their whole text.

    A null or empty text has length 0; repeated rows count each; the doc_id
    is not looked at.  An empty table gives no rows.
    """

    def emit(_, packed):
        counts = Counter(len(ids) // 4 for ids in packed)
        yield batch({"length": list(counts), "n_docs": list(counts.values())}, _COUNTS)

    prepare(docs.sparkSession)
    return (encoded(docs, emit, "length long, n_docs long", path)
            .groupBy("length").agg(F.sum("n_docs").alias("n_docs")))


def _after(df: DataFrame, span: Column, out: dict[str, Column]) -> DataFrame:
    """Sums of ``out`` over all longer lengths, in two levels."""
    df = df.withColumn("span", span)
    ranges = df.groupBy("span").agg(*(F.sum(v).alias(k) for k, v in out.items()))
    # One row per range of lengths in use: the longest text / RANGE at most.
    later = Window.orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    ranges = ranges.select("span", *(F.coalesce(F.sum(k).over(later), F.lit(0)).alias(f"{k}_later") for k in out))
    within = Window.partitionBy("span").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    df = df.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"{k}_within") for k, v in out.items()))
    return df.join(ranges, "span").select(
        "length", "n_docs", *((F.col(f"{k}_within") + F.col(f"{k}_later")).alias(k) for k in out))


def context_table(counts: DataFrame) -> DataFrame:
    """One row per length in use, the answers for a context limit of that length:

    docs_over / tokens_over: documents that are longer, and all their tokens;
    docs_within, share_within: documents that fit, and their share (the
    quantile the length is at); tokens_within: their tokens; tokens_kept: the
    total if every document is cut at the limit; tokens_cut: what is lost.
    Between two rows the totals are linear in the limit: see ``at_limit``.
    """
    counts = Scratch(prepare(counts.sparkSession), "token-counts").write(counts, "histogram")
    total = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
                       F.coalesce(F.sum(F.col("n_docs") * F.col("length")), F.lit(0)).alias("tokens")).first()
    docs, tokens = F.lit(total["docs"]), F.lit(total["tokens"])
    over = _after(counts, F.floor(F.col("length") / RANGE),
                  {"docs_over": F.col("n_docs"), "tokens_over": F.col("n_docs") * F.col("length")})
    return over.select(
        "length", "n_docs", "docs_over", "tokens_over",
        (docs - F.col("docs_over")).alias("docs_within"),
        ((docs - F.col("docs_over")) / docs).alias("share_within"),
        (tokens - F.col("tokens_over")).alias("tokens_within"),
        (tokens - F.col("tokens_over") + F.col("docs_over") * F.col("length")).alias("tokens_kept"),
        (F.col("tokens_over") - F.col("docs_over") * F.col("length")).alias("tokens_cut"))


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """(limit, tokens_kept, docs_over) for any limit from the answers at lengths in use."""
    fits = F.col("length") <= limit
    found = answers.agg(
        F.max_by(F.when(fits, F.struct("length", "tokens_kept", "docs_over")), F.when(fits, F.col("length"))).alias("b"),
        F.sum("n_docs").alias("docs"))
    start = F.coalesce(F.col("b.length"), F.lit(0))
    longer = F.coalesce(F.col("b.docs_over"), F.col("docs"), F.lit(0))
    return found.select(
        F.lit(limit).cast("long").alias("limit"),
        (F.coalesce(F.col("b.tokens_kept"), F.lit(0)) + longer * (F.lit(limit) - start)).alias("tokens_kept"),
        longer.alias("docs_over"))


def quantile(answers: DataFrame, share: float) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents fits in."""
    return answers.where(F.col("share_within") >= share).agg(
        F.lit(share).alias("share"), F.min("length").alias("length"))
