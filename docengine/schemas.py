"""Declared schemas of the stored tables, and the write-time conformity step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, TEXTS = T.StringType(), T.ArrayType(T.StringType())
LONG, INT, DOUBLE, FLAG = T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DATE, TIME, BYTES = T.DateType(), T.TimestampType(), T.BinaryType()


def layout(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, t, c not in required) for c, t in columns.items()])


# The layouts every reader of these tables expects.  The content
# hash is the extra key that lets a newer file for a known id be noticed.
PAYLOAD = layout(
    drug_name=TEXT, generic_name=TEXT, manufacturer=TEXT, ndc_codes=TEXTS, label_version=TEXT,
    effective_date=TEXT, indication=TEXT, contraindications=TEXT, dosage_forms=TEXTS,
    dosage_instructions=TEXT, warnings=TEXT, adverse_events=TEXTS, drug_interactions=TEXTS,
    mechanism_of_action=TEXT,
)
TABLES: dict[str, T.StructType] = {
    "raw": layout(
        ("file_path",),
        file_path=TEXT, file_name=TEXT, file_type=TEXT, source_url=TEXT, set_id=TEXT, raw_bytes=BYTES,
        file_size_bytes=LONG, file_modified_time=TIME, ingest_timestamp=TIME, source_batch_id=TEXT,
        content_hash=TEXT,
    ),
    "extracted": layout(
        ("file_path",),
        file_path=TEXT, set_id=TEXT, source_batch_id=TEXT, drug_name=TEXT, generic_name=TEXT,
        manufacturer=TEXT, ndc_codes=TEXTS, label_version=TEXT, effective_date=DATE, indication=TEXT,
        contraindications=TEXT, dosage_forms=TEXTS, dosage_instructions=TEXT, warnings=TEXT,
        adverse_events=TEXTS, drug_interactions=TEXTS, mechanism_of_action=TEXT, full_text=TEXT,
        model_endpoint=TEXT, prompt_version=TEXT, confidence_score=DOUBLE, extracted_at=TIME,
        content_hash=TEXT,
    ),
    "quarantine": layout(
        file_path=TEXT, source_batch_id=TEXT, failure_stage=TEXT, failure_reason=TEXT, raw_response=TEXT,
        quarantined_at=TIME, set_id=TEXT, prompt_version=TEXT, content_hash=TEXT,
    ),
    "dim": layout(
        ("set_id",),
        drug_sk=LONG, set_id=TEXT, label_version=TEXT, drug_name=TEXT, generic_name=TEXT, manufacturer=TEXT,
        effective_date=DATE, mechanism_of_action=TEXT, indication_summary=TEXT, is_current_version=FLAG,
        created_at=TIME,
    ),
    "fact": layout(
        ("drug_sk", "adverse_event"),
        drug_sk=LONG, set_id=TEXT, adverse_event=TEXT, label_version=TEXT, effective_date=DATE, created_at=TIME,
    ),
    "chunks": layout(
        ("chunk_id", "chunk_text"),
        chunk_id=TEXT, set_id=TEXT, drug_name=TEXT, generic_name=TEXT, manufacturer=TEXT, label_version=TEXT,
        section_title=TEXT, chunk_index=INT, chunk_text=TEXT, created_at=TIME,
    ),
    "violations": layout(
        ("check_id", "target_table", "checked_at"),
        check_id=TEXT, target_table=TEXT, layer=TEXT, severity=TEXT, violation_count=LONG,
        row_count_total=LONG, message=TEXT, run_id=TEXT, checked_at=TIME,
    ),
    "runs": layout(
        ("run_id",),
        run_id=TEXT, checks_total=LONG, checks_passed=LONG, checks_failed=LONG, run_started_at=TIME,
        run_finished_at=TIME,
    ),
}


def ensure_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to ``schema``; a NULL in a NOT NULL column fails the write.

    Columns missing from ``df`` become typed NULLs, columns unknown to the
    schema are dropped.
    """
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        if not field.nullable:
            column = F.coalesce(
                column,
                F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}")).cast(field.dataType),
            )
        out.append(column.alias(field.name))
    return df.select(*out)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
