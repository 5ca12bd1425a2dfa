"""Dashboards over the logs: quality, freshness, cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.functions.dates import hours_between, moment, since, since_date, tag_startswith, tag_value
from docengine.functions.scoring import bucket_floor, score_bucket
from docengine.operators.ingest import last_loaded
from docengine.operators.joins import asof_join, interval_join, union_all, with_lookup


def pass_rate(runs: DataFrame, days: int = 30) -> DataFrame:
    """Share of passed checks per day, for the last ``days`` days present."""
    return (
        runs.groupBy(F.to_date("run_started_at").alias("run_date"))
        .agg(
            F.sum("checks_passed").alias("checks_passed"),
            F.sum("checks_failed").alias("checks_failed"),
            F.round(
                F.try_divide(F.lit(100.0) * F.sum("checks_passed"), F.sum("checks_total")), 1
            ).alias("pass_rate_pct"),
        )
        .orderBy(F.desc("run_date"))
        .limit(days)
    )


def top_failing(violations: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """Checks by number of violations in the last days."""
    keys = ("check_id", "target_table", "severity")
    return (
        violations.filter(since("checked_at", days, as_of))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("run_count_with_failure"),
            F.sum("violation_count").alias("total_violations"),
            F.max("checked_at").alias("last_failed_at"),
        )
        .orderBy(F.desc("total_violations"), *keys)
    )


def recent_violations(violations: DataFrame, n: int = 50) -> DataFrame:
    cols = ("checked_at", "run_id", "check_id", "target_table", "severity",
            "violation_count", "row_count_total", "message")
    return violations.select(*cols).orderBy(F.desc("checked_at"), "run_id", "check_id").limit(n)


def score_histogram(df: DataFrame, score_col: str = "confidence_score", out: str = "labels") -> DataFrame:
    """Rows per score bucket, best bucket first."""
    return (
        df.groupBy(score_bucket(score_col).alias("confidence_bucket"), bucket_floor(score_col).alias("_floor"))
        .agg(F.count("*").alias(out))
        .orderBy(F.desc("_floor"))
        .drop("_floor")
    )


def quarantine_watch(quarantine: DataFrame, time_col: str = "quarantined_at") -> DataFrame:
    return (
        quarantine.groupBy(F.to_date(time_col).alias("quarantine_date"), "failure_stage")
        .agg(F.count("*").alias("rows_quarantined"))
        .orderBy(F.desc("quarantine_date"), "failure_stage")
    )


def freshness(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    targets: Sequence[tuple[str, str, int]],
    as_of=None,
) -> DataFrame:
    """Hours since the last load of every table against its limit.

    ``targets``: (table, time column, limit in hours).  Compared unrounded;
    exactly at the limit is still ok.
    """
    lookup = spark.createDataFrame(list(targets), "table_path STRING, timestamp_col STRING, sla_hours INT")
    measured = union_all(
        [last_loaded(tables[t], c).select(F.lit(t).alias("table_path"), "last_loaded_at") for t, c, _ in targets]
    )
    age = hours_between(moment(as_of), F.col("last_loaded_at"))
    status = (
        F.when(F.col("last_loaded_at").isNull(), "no_data")
        .when(age > F.col("sla_hours"), "BREACH")
        .otherwise("ok")
    )
    return (
        with_lookup(measured, lookup, "table_path")
        .select(
            "table_path", "last_loaded_at", "sla_hours",
            F.round(age, 1).alias("hours_since_load"), status.alias("sla_status"),
        )
        .orderBy(F.desc("hours_since_load"), "table_path")
    )


# Amounts are summed as decimals: exact, and the same in whatever order.  The
# product of both keeps all its 20 decimals and has 18 digits before them.
QUANTITY, PRICE = "decimal(21,8)", "decimal(16,12)"


def _total(amount: Column) -> Column:
    return F.round(F.sum(amount), 2).cast("double")


def _cost() -> Column:
    return F.col("usage_quantity") * F.col("list_price").cast(PRICE)


def priced_usage(
    usage: DataFrame,
    prices: DataFrame,
    currency: str = "USD",
    bucket_seconds: int | None = None,
    asof: bool = False,
) -> DataFrame:
    """Usage rows with the list price in force when the usage began.

    asof: by the last price that began, for lists of many or long periods.
    """
    rates = prices.filter(F.col("currency_code") == currency).select(
        "sku_name", "list_price", "price_start_time", "price_end_time"
    )
    times = ["sku_name"], "usage_start_time", "price_start_time", "price_end_time"
    if asof:
        priced = asof_join(usage, rates, *times, **({"bucket_seconds": bucket_seconds} if bucket_seconds else {}))
    else:
        priced = interval_join(usage, rates, *times, bucket_seconds)
    return priced.drop("price_start_time", "price_end_time")


def _job_usage(usage: DataFrame, prefix: str, days: int | None, as_of, tag: str) -> DataFrame:
    rows = usage.filter(tag_startswith("custom_tags", tag, prefix))
    if days is not None:
        rows = rows.filter(since_date("usage_start_time", days, as_of))
    return rows.select(
        "sku_name", "usage_start_time", F.col("usage_quantity").cast(QUANTITY).alias("usage_quantity"),
        tag_value("custom_tags", tag).alias("job_name"),
    )


def cost_by_job(usage: DataFrame, prices: DataFrame, prefix: str, days: int | None = 14, as_of=None,
                tag: str = "job_name", bucket_seconds: int | None = None, asof: bool = False) -> DataFrame:
    """Usage and cost by day and job."""
    rows = _job_usage(usage, prefix, days, as_of, tag)
    priced = priced_usage(rows, prices, bucket_seconds=bucket_seconds, asof=asof)
    return (
        priced.groupBy(F.to_date("usage_start_time").alias("usage_date"), "job_name")
        .agg(
            _total(F.col("usage_quantity")).alias("dbus_consumed"),
            _total(_cost()).alias("estimated_cost_usd"),
        )
        .orderBy(F.desc("usage_date"), F.desc("estimated_cost_usd"), "job_name")
    )


def cost_by_stage(usage: DataFrame, prices: DataFrame, prefix: str, pattern: str, days: int | None = 14,
                  as_of=None, tag: str = "job_name", bucket_seconds: int | None = None) -> DataFrame:
    """Cost by pipeline stage: group 1 of ``pattern`` in the job name."""
    priced = priced_usage(_job_usage(usage, prefix, days, as_of, tag), prices, bucket_seconds=bucket_seconds)
    stage: Column = F.regexp_extract("job_name", pattern, 1)
    return (
        priced.groupBy(stage.alias("stage"))
        .agg(
            _total(_cost()).alias("cost_usd_14d"),
            _total(F.col("usage_quantity")).alias("dbus_14d"),
        )
        .orderBy(F.desc("cost_usd_14d"), "stage")
    )
