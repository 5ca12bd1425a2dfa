"""Look-ups over the dimension, the fact and the passage index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions.text import icontains, trim_passage
from docengine.operators.joins import union_all
from docengine.operators.similarity import similarity_topk


def _name_match(names: Sequence[str], needle: Column | str) -> Column:
    return reduce(or_, [icontains(c, needle) for c in names])


def entity_summary(
    dim: DataFrame,
    fact: DataFrame,
    name: str,
    names: Sequence[str] = ("drug_name", "generic_name"),
    cols: Sequence[str] = (
        "drug_name", "generic_name", "manufacturer", "effective_date",
        "indication_summary", "mechanism_of_action",
    ),
    sk_col: str = "drug_sk",
    current_col: str = "is_current_version",
    date_col: str = "effective_date",
    k: int = 5,
    out: str = "adverse_event_count",
) -> DataFrame:
    """The k best matches by name with their number of facts, 0 when none.

    Members are chosen first, so facts are counted for k keys only and the
    fact side needs no shuffle beyond k partial counts per task.
    """
    order = [F.desc(current_col), F.desc(date_col), F.col(sk_col)]
    chosen = (
        dim.filter(_name_match(names, name))
        .select(*dict.fromkeys([sk_col, current_col, date_col, *cols]))
        .orderBy(*order)
        .limit(k)
    )
    # k rows: a fixed bound.
    counted = (
        fact.select(sk_col)
        .join(F.broadcast(chosen.select(sk_col)), sk_col, "left_semi")
        .groupBy(sk_col)
        .agg(F.count("*").alias("_n"))
    )
    return (
        chosen.join(counted, sk_col, "left")
        .withColumn(out, F.coalesce("_n", F.lit(0)))
        .orderBy(*order)
        .select(*cols, out)
    )


def find_by_event(
    dim: DataFrame,
    fact: DataFrame,
    event: str,
    limit: int = 20,
    cols: Sequence[str] = ("drug_name", "generic_name", "manufacturer"),
    sk_col: str = "drug_sk",
    event_col: str = "adverse_event",
) -> DataFrame:
    """Members whose facts mention ``event``, by name; distinct before and after the join."""
    hits = fact.filter(icontains(event_col, event)).select(sk_col, event_col).distinct()
    return (
        hits.join(dim.select(sk_col, *cols), sk_col)
        .select(*cols, event_col)
        .distinct()
        .orderBy(*cols, event_col)
        .limit(limit)
    )


def search_passages(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    cols: Sequence[str] = ("set_id", "drug_name", "section_title", "chunk_text"),
    text_col: str = "chunk_text",
    id_col: str = "chunk_id",
    vec_col: str = "embedding",
    limit_chars: int = 1200,
    **options,
) -> DataFrame:
    """The k nearest passages of every query, cut for display, with citation columns."""
    hits = similarity_topk(index, queries, k, id_col, vec_col, cols=cols, **options)
    return hits.withColumn(text_col, trim_passage(text_col, limit_chars))


def search_within(
    index: DataFrame,
    entities: DataFrame,
    queries: DataFrame,
    on: str = "set_id",
    **options,
) -> DataFrame:
    """Passages of the chosen entities only: a structured filter, then the search."""
    ids = entities.select(on).distinct()
    return search_passages(index.join(ids, on, "left_semi"), queries, **options)


def citations(hits: DataFrame, query_id: str = "query_id", name_col: str = "drug_name",
              section_col: str = "section_title", out: str = "sources") -> DataFrame:
    """``<name> — <section>`` lines of the hits of every query, distinct and sorted.

    Hits without a name or section are not cited.  A query has at most k hits,
    so the collected set is bounded.
    """
    line = F.concat(name_col, F.lit(" — "), section_col)
    return hits.groupBy(query_id).agg(
        F.array_join(F.array_sort(F.collect_set(line)), "\n").alias(out)
    )


def grams(c: Column | str, size: Column | int = 3) -> Column:
    """Distinct runs of ``size`` characters of a text, letters in lower case."""
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    size = F.lit(size) if isinstance(size, int) else size
    count = F.length(text) - size + 1
    return F.when(count > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: text.substr(i, size)))).otherwise(
        F.array().cast("array<string>"))


def containing(texts: DataFrame, text_col: str, questions: DataFrame, question_id: str, needle: str) -> DataFrame:
    """(question id, text) of the distinct ``texts`` that contain the needle of a question, ignoring case.

    A text can only contain a needle if it has the needle's grams, so the two
    meet by equality: a needle under its rarest run of three characters (or
    all of it, if shorter), a text under its runs of one, two and three that
    some needle is filed under.  ``contains`` decides.  An empty needle is in
    every text and is filed under the empty gram; NULL matches nothing.
    """
    asked = questions.filter(F.col(needle).isNotNull()).select(question_id, needle).withColumn(
        "_grams", grams(needle, F.least(F.lit(3), F.length(needle))))
    asked = asked.withColumn("_grams", F.when(F.length(needle) == 0, F.array(F.lit(""))).otherwise(F.col("_grams")))
    wanted = asked.select(F.explode("_grams").alias("_gram")).distinct()
    runs = F.concat(F.array(F.lit("")), *(grams(text_col, n) for n in (1, 2, 3)))
    filed = texts.filter(F.col(text_col).isNotNull()).select(text_col, F.explode(runs).alias("_gram"))
    filed = filed.join(wanted, "_gram", "left_semi")
    often = filed.groupBy("_gram").agg(F.count("*").alias("_often"))
    # A gram that no text has is the rarest of all: its needle meets nothing.
    ranked = asked.select(question_id, needle, F.explode("_grams").alias("_gram")).join(often, "_gram", "left")
    under = ranked.groupBy(question_id, needle).agg(
        F.min(F.struct(F.coalesce("_often", F.lit(0)), "_gram")).alias("_least")).select(
        question_id, needle, F.col("_least._gram").alias("_gram"))
    return filed.join(under, "_gram").filter(icontains(text_col, F.col(needle))).select(question_id, text_col)


def answer_names(
    questions: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    names: Sequence[str],
    cols: Sequence[str],
    sk_col: str = "drug_sk",
    current_col: str = "is_current_version",
    date_col: str = "effective_date",
    question_id: str = "question_id",
    needle: str = "question",
    k: int = 5,
    out: str = "adverse_event_count",
) -> DataFrame:
    """``entity_summary`` for a table of questions.

    Questions meet the distinct names (``containing``), matching names the
    members by equality.  The k best per question are kept before the shuffle
    (group limit), and facts are counted for the chosen members only.
    """
    w = Window.partitionBy(question_id).orderBy(F.desc(current_col), F.desc(date_col), F.col(sk_col))
    members = dim.select(*dict.fromkeys([sk_col, current_col, date_col, *names, *cols]))
    every = union_all([dim.select(F.col(c).alias("_name")) for c in names]).distinct()
    found = containing(every, "_name", questions, question_id, needle)
    by_name = [found.join(members.select(sk_col, F.col(c).alias("_name")), "_name").select(question_id, sk_col)
               for c in names]
    chosen = (
        union_all(by_name).distinct().join(members, sk_col)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )
    counts = (
        fact.select(sk_col).join(chosen.select(sk_col).distinct(), sk_col, "left_semi")
        .groupBy(sk_col).agg(F.count("*").alias("_n"))
    )
    return (
        chosen.join(counts, sk_col, "left")
        .withColumn(out, F.coalesce("_n", F.lit(0)))
        .select(question_id, "rank", *cols, out)
    )


def answer_events(
    questions: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    cols: Sequence[str],
    sk_col: str = "drug_sk",
    event_col: str = "adverse_event",
    question_id: str = "question_id",
    needle: str = "question",
    limit: int = 20,
) -> DataFrame:
    """``find_by_event`` for a table of questions.

    Questions meet the distinct event texts (``containing``), not the facts;
    the matching texts then join the facts by equality.
    """
    matched = containing(fact.select(event_col).distinct(), event_col, questions, question_id, needle)
    w = Window.partitionBy(question_id).orderBy(*cols, event_col)
    return (
        fact.select(sk_col, event_col)
        .distinct()
        .join(matched, event_col)
        .join(dim.select(sk_col, *cols), sk_col)
        .select(question_id, *cols, event_col)
        .distinct()
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= limit)
    )
