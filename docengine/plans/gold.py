"""Daily job: extracted fields -> dimension, fact and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.operators.chunker import chunk
from docengine.operators.model import best_row, build_fact, refresh_dim
from docengine.sources.tables import Snapshots

KEYS = ("set_id", "label_version")
# Dimension column -> extracted column.
DIM_COLUMNS = {
    "drug_name": "drug_name",
    "generic_name": "generic_name",
    "manufacturer": "manufacturer",
    "effective_date": "effective_date",
    "mechanism_of_action": "mechanism_of_action",
    "indication_summary": "indication",
}


def best_first() -> list[Column]:
    """Highest score wins, then the latest; the path makes the order total."""
    return [F.desc("confidence_score"), F.desc("extracted_at"), F.asc("file_path")]


def next_dim(extracted: DataFrame, dim: DataFrame, as_of: Column | None = None, strict: bool = False) -> DataFrame:
    return refresh_dim(
        extracted, dim, KEYS, DIM_COLUMNS, best_first(), as_of=as_of, strict=strict,
        tie_break=("label_version",) if strict else (),
    )


def facts(extracted: DataFrame, dim: DataFrame, dedupe: bool = True, as_of: Column | None = None) -> DataFrame:
    as_of = F.current_timestamp() if as_of is None else as_of
    return build_fact(
        extracted, dim, KEYS, "adverse_events", order=best_first() if dedupe else None, as_of=as_of
    )


def chunks(extracted: DataFrame, max_chars: int = 2000, overlap: int = 200, min_chars: int = 100,
           as_of: Column | None = None, versioned: bool = True) -> DataFrame:
    """Chunks of the best row per version; ``versioned=False`` numbers ids as ``<id>_<n>``."""
    as_of = F.current_timestamp() if as_of is None else as_of
    # The best row first, as in the dimension: a short one has no chunks, and no other row steps in for it.
    rows = best_row(extracted, KEYS, best_first()).filter(F.length("full_text") > min_chars)
    keep = ("set_id", "drug_name", "generic_name", "manufacturer", "label_version")
    return chunk(
        rows, "set_id", "full_text", keep, "label_version" if versioned else None,
        max_chars, overlap, min_chars, as_of,
    )


def refresh_gold(extracted: DataFrame, dim: Snapshots, fact: Snapshots, passages: Snapshots) -> dict[str, int]:
    """Write the next version of the three tables; returns the version numbers.

    The fact is built from the written dimension, so both use the same keys.
    """
    versions = {"dim": dim.write(next_dim(extracted, dim.read()))}
    versions["fact"] = fact.write(facts(extracted, dim.read()))
    versions["chunks"] = passages.write(chunks(extracted))
    return versions
