"""Text -> typed fields -> score -> route."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.functions.scoring import confidence
from docengine.functions.text import as_col
from docengine.schemas import PAYLOAD

# Fields an extraction must name, and the three failure stages.
REQUIRED = ("drug_name", "generic_name", "indication", "adverse_events", "drug_interactions")
PARSE_ERROR = "parse_error"
SCHEMA_VIOLATION = "schema_violation"
LOW_CONFIDENCE = "low_confidence"

CORRUPT = "_corrupt_record"
STRINGS = T.ArrayType(T.StringType())

Extractor = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """How one field is found.

    ``section``: body of the first section whose title matches ``pattern``.
    ``first`` / ``all``: first match / distinct matches of ``pattern`` in the text.
    ``items``: the section body cut into list items at ``split``.

    ``needs`` is a piece of text every match contains; texts without it are
    told by a plain search and never reach the regular expression.
    """

    how: str
    pattern: str
    group: int = 0
    split: str = r"[,;\n•]+"
    max_chars: int | None = None
    needs: str | None = None


def _apply(rule: Rule, text: Column, sections: Column | None) -> Column:
    possible = F.contains(text, F.lit(rule.needs)) if rule.needs else None
    if rule.how == "first":
        value = F.nullif(F.regexp_extract(text, rule.pattern, rule.group), F.lit(""))
        if possible is not None:
            value = F.when(possible, value)
    elif rule.how == "all":
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)))
        if possible is None:
            return found
        return F.when(possible, found).otherwise(F.when(text.isNotNull(), F.array().cast(STRINGS)))
    else:
        if sections is None:
            raise ValueError(f"rule {rule.how!r} needs the sections")
        hits = F.filter(sections, lambda s: s["title"].rlike(rule.pattern))
        value = F.get(hits, 0)["body"]
        if rule.how == "items":
            parts = F.transform(F.split(value, rule.split), lambda p: F.trim(p))
            return F.coalesce(
                F.array_distinct(F.filter(parts, lambda p: p != "")),
                F.array().cast(STRINGS),
            )
    return F.substring(value, 1, rule.max_chars) if rule.max_chars else value


def rule_extractor(
    rules: Mapping[str, Rule], text: Column | str, sections: Column | str | None = None
) -> Column:
    """JSON payload found by rules: an extractor that stays inside the JVM."""
    text = as_col(text)
    sections = None if sections is None else as_col(sections)
    fields = [_apply(rule, text, sections).alias(name) for name, rule in rules.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


# Section headings of the label documents.
LABEL_RULES: dict[str, Rule] = {
    "drug_name": Rule("first", r"(?m)^(?:## )?(?i:brand name|drug name)\s*:\s*([^\n]+)$", 1),
    "generic_name": Rule("first", r"(?m)^(?:## )?(?i:generic name)\s*:\s*([^\n]+)$", 1),
    "manufacturer": Rule("first", r"(?im)(?:manufactured (?:by|for)|distributed by)\s*:?\s*([^\n.]+)", 1),
    "ndc_codes": Rule("all", r"\b\d{4,5}-\d{3,4}-\d{1,2}\b"),
    "label_version": Rule("first", r"(?im)\bversion\s*:?\s*(\d+)\b", 1),
    "effective_date": Rule("first", r"(?im)(?:effective|revised)[^\n\d]{0,20}(\d{4}-\d{2}-\d{2})", 1),
    "indication": Rule("section", r"(?i)indications?( and|\b)"),
    "contraindications": Rule("section", r"(?i)^\W*[\d.]*\s*contraindications?"),
    "dosage_forms": Rule("items", r"(?i)dosage forms?"),
    "dosage_instructions": Rule("section", r"(?i)dosage and administration"),
    "warnings": Rule("section", r"(?i)warnings?"),
    "adverse_events": Rule("items", r"(?i)adverse (reactions?|events?)"),
    "drug_interactions": Rule("items", r"(?i)drug interactions?"),
    "mechanism_of_action": Rule("section", r"(?i)mechanism of action"),
}


def label_extractor(text: Column | str, sections: Column | str) -> Column:
    return rule_extractor(LABEL_RULES, text, sections)


def extract(df: DataFrame, payload: Column, out: str = "extraction_json") -> DataFrame:
    """Attach the payload; ``payload`` is a rule column or any Arrow UDF over the text."""
    return df.withColumn(out, payload)


def parse_payload(col: Column | str, schema: T.StructType = PAYLOAD) -> Column:
    """Typed struct of a JSON payload plus a field that holds unreadable input."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(as_col(col), wide, {"columnNameOfCorruptRecord": CORRUPT})


def is_malformed(json: Column | str, parsed: Column | str) -> Column:
    """NULL payload or text that is not JSON of the schema."""
    return as_col(json).isNull() | as_col(parsed).getField(CORRUPT).isNotNull()


def missing_fields(json: Column | str, required: tuple[str, ...] = REQUIRED) -> Column:
    """Required fields the payload does not name, in the order of ``required``."""
    present = F.coalesce(F.json_object_keys(as_col(json)), F.array().cast(STRINGS))
    return F.array_except(F.array(*[F.lit(r) for r in required]), present)


def score(
    df: DataFrame, json_col: str = "extraction_json", out: str = "confidence_score", schema=PAYLOAD
) -> DataFrame:
    """Parse once; add the struct ``x``, ``malformed`` and the score."""
    return (
        df.withColumn("x", parse_payload(json_col, schema))
        .withColumn("malformed", is_malformed(json_col, "x"))
        .withColumn(out, confidence("x"))
    )


def with_route(
    df: DataFrame,
    score_col: str = "confidence_score",
    threshold: float = 0.6,
    parse_failed: Column | None = None,
    malformed: Column | None = None,
) -> DataFrame:
    """Add ``failure_stage`` (NULL for a good row) and ``route``.

    One decision column serves the good branch, the quarantine branch and the
    counts, so the costly columns below it are read once.
    """
    stage = F.when(parse_failed, PARSE_ERROR) if parse_failed is not None else None
    if malformed is not None:
        stage = (F.when if stage is None else stage.when)(malformed, SCHEMA_VIOLATION)
    low = F.coalesce(F.col(score_col) < threshold, F.lit(True))
    stage = (F.when if stage is None else stage.when)(low, LOW_CONFIDENCE)
    return df.withColumn("failure_stage", stage).withColumn(
        "route", F.when(F.col("failure_stage").isNull(), "extracted").otherwise("quarantined")
    )


def route(df: DataFrame, score_col: str = "confidence_score", threshold: float = 0.6):
    """(good, quarantine) branches of a scored DataFrame."""
    return df.filter(F.col(score_col) >= threshold), df.filter(
        ~F.coalesce(F.col(score_col) >= threshold, F.lit(False))
    )


def flatten_struct(df: DataFrame, col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, f"{col}.*")


def stamp(df: DataFrame, as_of: Column | None = None, time_col: str = "extracted_at", **values) -> DataFrame:
    """Lineage columns: constants (None = typed NULL string) and a load time."""
    columns = {k: F.lit(v) if v is not None else F.lit(None).cast("string") for k, v in values.items()}
    columns[time_col] = (F.current_timestamp() if as_of is None else as_of).cast("timestamp")
    return df.withColumns(columns)


def run_summary(routed: DataFrame, **context: str) -> DataFrame:
    """Extracted, quarantined and pending rows of a run, from one pass."""
    out = routed.agg(
        F.count_if(F.col("route") == "extracted").alias("extracted"),
        F.count_if(F.col("route") == "quarantined").alias("quarantined"),
        F.count("*").alias("pending_at_start"),
    )
    return out.withColumns({k: F.lit(v) for k, v in context.items()}) if context else out


def quarantine_rate(routed: DataFrame, limit_pct: float = 5.0) -> DataFrame:
    """Share of quarantined rows, and whether it is above the limit."""
    n = F.count("*")
    bad = F.count_if(F.col("route") == "quarantined")
    return routed.agg(bad.alias("quarantined"), n.alias("total")).withColumns(
        {
            "quarantine_pct": F.round(F.try_divide(F.col("quarantined") * 100.0, F.col("total")), 2),
            "alarm": F.coalesce(
                F.try_divide(F.col("quarantined") * 100.0, F.col("total")) > limit_pct, F.lit(False)
            ),
        }
    )


def extraction_preview(
    df: DataFrame,
    score_col: str,
    arrays: Mapping[str, str],
    text_col: str,
    keep: tuple[str, ...],
    n: int = 20,
    chars: int = 120,
) -> DataFrame:
    """Best rows with array sizes and a text preview; ``keep`` breaks ties."""
    sizes = [F.size(F.coalesce(c, F.array())).alias(out) for c, out in arrays.items()]
    return (
        df.select(*keep, score_col, *sizes, F.substring(text_col, 1, chars).alias(f"{text_col}_preview"))
        .orderBy(F.desc(score_col), *keep)
        .limit(n)
    )
