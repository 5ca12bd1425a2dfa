"""Confidence score and score buckets."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (field, how it counts, weight).  Decimals, so that a sum of
# 0.60 is exactly 0.60 and passes a threshold of 0.6.
WEIGHTS: tuple[tuple[str, str, str], ...] = (
    ("drug_name", "present", "0.20"),
    ("generic_name", "present", "0.15"),
    ("indication", "present", "0.20"),
    ("adverse_events", "nonempty", "0.20"),
    ("drug_interactions", "nonempty", "0.15"),
    ("mechanism_of_action", "present", "0.10"),
)

# Lower bound and label, highest first; the last takes the rest.
BUCKETS: tuple[tuple[float, str], ...] = (
    (0.9, "0.9–1.0"),
    (0.8, "0.8–0.9"),
    (0.7, "0.7–0.8"),
    (0.6, "0.6–0.7"),
    (0.5, "0.5–0.6"),
)
BUCKET_REST = "< 0.5"


def weighted_score(terms: list[tuple[Column, str]]) -> Column:
    """Sum of the weights of the conditions that hold; a NULL condition counts 0."""
    parts = [F.coalesce(cond, F.lit(False)).cast("int") * F.lit(Decimal(w)) for cond, w in terms]
    return reduce(add, parts).cast("double")


def confidence(payload: Column | str, weights=WEIGHTS) -> Column:
    """Completeness score of an extraction struct; never NULL."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    terms = []
    for field, how, weight in weights:
        value = payload.getField(field)
        if how == "present":
            terms.append((value.isNotNull(), weight))
        else:
            terms.append((F.size(F.coalesce(value, F.array())) > 0, weight))
    return weighted_score(terms)


def score_bucket(score: Column | str, buckets=BUCKETS, rest: str = BUCKET_REST) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    chain = None
    for floor, label in buckets:
        chain = (F.when if chain is None else chain.when)(score >= floor, label)
    return chain.otherwise(rest)


def bucket_floor(score: Column | str, buckets=BUCKETS) -> Column:
    """Numeric sort key of the bucket, so that the order is by score, not by label text."""
    score = F.col(score) if isinstance(score, str) else score
    chain = None
    for floor, _ in buckets:
        chain = (F.when if chain is None else chain.when)(score >= floor, F.lit(floor))
    return chain.otherwise(F.lit(0.0))
