"""From documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's documents:

toxicity           documents graded toxic go
line_templates     lines of recurring templates go, n_chars follows the text
near_duplicates    one document of each group stays
decontamination    documents that hold a window of the benchmark go
packing            the pieces of the documents left, with sequence and offset

All but the last return the columns of documents.  Each stage says in its
operator's docstring what becomes of nulls, empty texts, ties and repeated
rows; extra columns of documents are carried along up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm import decontamination, line_templates, near_duplicates, packing, toxicity
from docengine.llm.common import Scratch, table


def aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but doc_id and text under names that no operator makes, and these names."""
    names = {c: c if c in ("doc_id", "text") else f"__column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def back(found: DataFrame, names: dict[str, str]) -> DataFrame:
    return found.select(*(F.col(new).alias(old) for old, new in names.items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held, names = aside(docs)
    return back(toxicity.scored(held, model).where(F.col("grade") == 0), names)


def drop_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, names = aside(docs)
    found = line_templates.without_templates(held)
    if "n_chars" in names:
        own = names["n_chars"]
        n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col(own))
        found = found.withColumn(own, n_chars.cast(docs.schema["n_chars"].dataType))
    return back(found, names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_templates", drop_template_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Tokens and minima have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
