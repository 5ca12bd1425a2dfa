"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm import (
    decontamination, fingerprints, html_text, language_model, line_templates, near_duplicates, packing, periodic, pii,
    ranked_search, repeats, token_counts, toxicity,
)
from docengine.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Pseudonyms of the registered query; a real run brings its own secret.
PII_KEY = b"key of the registered query"


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", "expected_severity", "grade", "p_toxic", (F.col("grade") > 0).alias("toxic"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymized(docs, PII_KEY).select(
        "doc_id", "text", F.size("pii_values").cast("long").alias("n_values"), "pii_values")


@query
def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.without_templates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op8_line_templates"] = line_templates.QUERY_SQL


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), similar=(85, 100))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_table(token_counts.histogram(table(spark, sf_dir, "documents")))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


ORACLES["op11_html_extraction"] = html_text.QUERY_SQL


def _looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by its hash repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise("")

    # The words are bound once, and made only where they are needed.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(words), looped)[0])
                       .otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
