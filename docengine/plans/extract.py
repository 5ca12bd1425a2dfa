"""Daily job: raw files -> extracted fields and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.dates import parse_date
from docengine.operators import extraction as ex
from docengine.operators.ingest import of_type
from docengine.operators.joins import pending_capped
from docengine.operators.sections import parse_sections, sections_to_text
from docengine.runtime import materialized
from docengine.schemas import TABLES, ensure_schema
from docengine.sources.tables import append_table, read_or_empty

KEYS = ("set_id", "content_hash")


@dataclass(frozen=True)
class ExtractConfig:
    batch_id: str
    extractor: Callable[[Column, Column], Column] = ex.label_extractor
    extractor_id: str = "rules"
    prompt_version: str = "v1"
    file_type: str = "xml"
    kind: str = "xml"
    limit: int | None = None
    min_chars: int = 200
    min_confidence: float = 0.6
    retry_quarantined: bool = False


def extracted_rows(raw: DataFrame, extracted: DataFrame, quarantine: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Pending rows with text, payload, score and route.

    Pending means that this content of this id is neither extracted nor, for
    the same prompt version, in quarantine.
    """
    done = [extracted]
    if not cfg.retry_quarantined:
        done.append(quarantine.filter(F.col("prompt_version") == cfg.prompt_version))
    todo = pending_capped(
        of_type(raw, cfg.file_type), *done, on=list(KEYS), order=["set_id", "file_path"], limit=cfg.limit
    ).select("file_path", *KEYS, "raw_bytes")
    text = (
        parse_sections(todo, "raw_bytes", cfg.kind)
        .drop("raw_bytes")
        .withColumn("full_text", sections_to_text("sections"))
    )
    usable = F.coalesce(F.length("full_text") > cfg.min_chars, F.lit(False))
    payload = F.when(usable, cfg.extractor(F.col("full_text"), F.col("sections")))
    scored = ex.score(ex.extract(text, payload).drop("sections"))
    return ex.with_route(
        scored, threshold=cfg.min_confidence, parse_failed=~usable, malformed=F.col("malformed")
    )


def to_extracted(routed: DataFrame, cfg: ExtractConfig) -> DataFrame:
    good = routed.filter(F.col("route") == "extracted")
    flat = good.select(
        "file_path", *KEYS, "full_text", "confidence_score", "x.*"
    ).withColumn("effective_date", parse_date("effective_date"))
    stamped = ex.stamp(
        flat, source_batch_id=cfg.batch_id, model_endpoint=cfg.extractor_id, prompt_version=cfg.prompt_version
    )
    return ensure_schema(stamped, TABLES["extracted"])


def to_quarantine(routed: DataFrame, cfg: ExtractConfig) -> DataFrame:
    stage = F.col("failure_stage")
    reason = (
        F.when(stage == ex.LOW_CONFIDENCE, F.col("confidence_score").cast("string"))
        .when(stage == ex.SCHEMA_VIOLATION, "payload is not JSON of the expected schema")
        .when(F.col("full_text").isNull(), "no readable section")
        .otherwise(F.concat(F.lit("text too short: "), F.length("full_text").cast("string")))
    )
    bad = routed.filter(F.col("route") == "quarantined").select(
        "file_path", *KEYS, "failure_stage", reason.alias("failure_reason"),
        F.coalesce("extraction_json", "full_text").alias("raw_response"),
    )
    stamped = ex.stamp(
        bad, time_col="quarantined_at", source_batch_id=cfg.batch_id, prompt_version=cfg.prompt_version
    )
    return ensure_schema(stamped, TABLES["quarantine"])


def extract_batch(spark, raw_path: str, extracted_path: str, quarantine_path: str, cfg: ExtractConfig) -> DataFrame:
    """Run one batch and return its summary row.

    The costly part - parsing and extraction - is written once to the shared
    folder; both branches and the counts read that copy.
    """
    raw = spark.read.parquet(raw_path)
    extracted = read_or_empty(spark, extracted_path, TABLES["extracted"])
    quarantine = read_or_empty(spark, quarantine_path, TABLES["quarantine"])
    with materialized(extracted_rows(raw, extracted, quarantine, cfg), "extraction") as routed:
        append_table(to_extracted(routed, cfg), extracted_path)
        append_table(to_quarantine(routed, cfg), quarantine_path)
        # One row; taken now because the copy is dropped at the end of the block.
        row = ex.run_summary(routed).collect()
    summary = spark.createDataFrame(row, "extracted BIGINT, quarantined BIGINT, pending_at_start BIGINT")
    return summary.select(
        F.lit(cfg.batch_id).alias("batch_id"), "*",
        F.lit(cfg.extractor_id).alias("model_endpoint"), F.lit(cfg.prompt_version).alias("prompt_version"),
    )
