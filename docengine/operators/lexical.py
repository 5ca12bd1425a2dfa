"""Ranked lexical search (BM25) over stored postings.

A posting is (term, id, part): what the term would add to the score of the
passage if its weight were 1.  Postings are kept sorted by term, a frequent
term over many files, and beside them every term's document frequency and its
largest part, which bound what it can add anywhere.

``search`` does not read the lists of all words of a question.  The words that
can add most give a score that k passages reach; words that together cannot
reach it are not looked for, but looked up for the passages that the others
bring.  So the rows that meet are those of the rare words' lists, not those of
the words that half of all passages have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docengine.runtime import materialize

K1, B = 1.2, 0.75
SPLIT = r"[^\p{L}\p{N}]+"
FIRST = 3  # words of a question that give the first score to beat
SCORE_DIGITS = 6
# Scores are summed in any order and compared after rounding.
SLACK = 2e-6


@dataclass(frozen=True)
class LexicalIndex:
    postings: DataFrame  # term, id, part
    terms: DataFrame     # term, weight, most
    passages: int


def words(text: Column | str) -> Column:
    """Words of a text in lower case: runs of letters and digits."""
    return F.filter(F.split(F.lower(F.col(text) if isinstance(text, str) else text), SPLIT), lambda w: w != "")


def asked_words(queries: DataFrame, query_id: str, text_col: str) -> DataFrame:
    return queries.filter(F.col(text_col).isNotNull()).select(
        query_id, F.explode(F.array_distinct(words(text_col))).alias("term"))


def build_lexical(spark: SparkSession, passages: DataFrame, path: str, id_col: str, text_col: str,
                  only: DataFrame | None = None) -> LexicalIndex:
    """Write the postings of ``passages`` (ids are unique) and open them.

    ``only`` (term): an index for questions of these words alone; weights and
    lengths are those of the whole texts.
    """
    held = passages.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), words(text_col).alias("_words"))
    held = held.select("id", "_words", F.size("_words").alias("_len")).filter(F.col("_len") > 0)
    held = materialize(held, "words")  # read twice; the passages are cut into words once
    n, total = held.agg(F.count("*"), F.coalesce(F.sum("_len"), F.lit(0))).first()
    spread = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("_len") / F.lit(total / n if n else 1.0))
    found = held.select("id", "_len", F.explode("_words").alias("term"))
    if only is not None:
        found = found.join(only.select("term").distinct(), "term", "left_semi")
    found = found.groupBy("id", "_len", "term").agg(F.count("*").alias("_tf")).select(
        "term", "id", (F.col("_tf") * (K1 + 1) / (F.col("_tf") + spread)).alias("part"))
    # A term that stands in most passages is split by their ids.
    shares = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found.repartitionByRange(shares, "term", "id").sortWithinPartitions("term", "id").write.parquet(f"{path}/postings")
    postings = spark.read.schema(found.schema).parquet(f"{path}/postings")
    df = F.count("*")
    weight = F.log(1 + (n - df + 0.5) / (df + 0.5))
    terms = postings.groupBy("term").agg(weight.alias("weight"), (weight * F.max("part")).alias("most"))
    terms.write.parquet(f"{path}/terms")
    spark.createDataFrame([(n,)], "passages long").write.parquet(f"{path}/about")
    return open_lexical(spark, path)


def open_lexical(spark: SparkSession, path: str) -> LexicalIndex:
    """A written index; what says that it is whole is written last."""
    n = spark.read.parquet(f"{path}/about").first()["passages"]
    return LexicalIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), n)


def _summed(rows: DataFrame, query_id: str) -> DataFrame:
    return rows.groupBy(query_id, "id").agg(F.sum("add").alias("score"))


def _kth(scores: DataFrame, query_id: str, k: int) -> DataFrame:
    """(query, floor): the k-th best score of each query that has k."""
    w = Window.partitionBy(query_id).orderBy(F.desc("score"))
    return (scores.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).filter(F.col("_r") == k)
            .select(query_id, F.col("score").alias("floor")))


def search(index: LexicalIndex, queries: DataFrame, k: int, query_id: str = "query_id",
           text_col: str = "text") -> DataFrame:
    """(query id, id, score, rank): the k best passages of every question that share a word, ties by id.

    A word counts once for a question, however often it stands there.
    """
    by_most = Window.partitionBy(query_id).orderBy(F.desc("most"), "term")
    asked = asked_words(queries, query_id, text_col).join(index.terms, "term").select(
        query_id, "term", "weight", F.row_number().over(by_most).alias("place"),
        F.sum("most").over(by_most.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("rest"))
    asked = materialize(asked, "asked")
    add = (F.col("part") * F.col("weight")).alias("add")

    first = index.postings.join(asked.filter(F.col("place") <= FIRST), "term").select(query_id, "id", add)
    floors = materialize(_kth(_summed(first, query_id), query_id, k), "floors")
    asked = asked.join(floors, query_id, "left").withColumn(
        "sought", F.col("floor").isNull() | (F.col("rest") >= F.col("floor") - SLACK))
    asked = materialize(asked, "asked")
    left = asked.groupBy(query_id).agg(
        F.coalesce(F.max(F.when(~F.col("sought"), F.col("rest"))), F.lit(0.0)).alias("left"))

    brought = index.postings.join(asked.filter("sought"), "term").select(query_id, "id", add)
    brought = materialize(_summed(brought, query_id), "brought")
    floors = _kth(brought, query_id, k)
    able = brought.join(left, query_id).join(floors, query_id, "left").filter(
        F.col("floor").isNull() | (F.col("score") + F.col("left") >= F.col("floor") - SLACK))
    able = materialize(able.select(query_id, "id", "score"), "able")
    looked_up = able.select(query_id, "id").join(
        asked.filter(~F.col("sought")).select(query_id, "term", "weight"), query_id)
    more = looked_up.join(index.postings, ["term", "id"]).select(query_id, "id", add)

    whole = _summed(able.withColumnRenamed("score", "add").unionByName(more), query_id)
    best = Window.partitionBy(query_id).orderBy(F.desc("score"), F.col("id").asc())
    return (whole.withColumn("score", F.round("score", SCORE_DIGITS)).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k).select(query_id, "id", "score", "rank"))
