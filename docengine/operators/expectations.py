"""Data-quality checks: definitions, evaluation in few jobs, logs and gate."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.operators.joins import no_overlap_violations, union_all
from docengine.schemas import TABLES, ensure_schema

ERROR, WARN = "error", "warn"
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class GroupRule:
    """What the rows of one table that share ``keys`` violate, from counts alone.

    ``violations`` takes the rows of a group, those with a true ``flag`` and
    those with a ``date``, and gives what the group adds to the count.
    """

    keys: tuple[str, ...]
    violations: Callable[[Column, Column, Column], Column]
    flag: str | None = None
    date: str | None = None


@dataclass(frozen=True)
class Check:
    """One assertion about one table.

    Row-level checks have ``bad``, TRUE on a violating row, and may ``adjust``
    the violating and total counts to the count that is reported.  Checks of
    groups have ``group``; both kinds share one scan of their table.  Other
    set-level checks have ``measure``, one row of violation_count and
    row_count_total.  All are functions, so checks can be declared before
    there is a session.
    """

    check_id: str
    target_table: str
    bad: Callable[[], Column] | None = None
    adjust: Callable[[Column, Column], Column] | None = None
    group: GroupRule | None = None
    measure: Callable[[Tables], DataFrame] | None = None
    layer: str | None = None
    severity: str = ERROR


# --- row-level conditions -------------------------------------------------


def is_missing(c: str) -> Column:
    return F.col(c).isNull()


def is_not_positive(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) <= 0)


def is_future(c: str, as_of: str | dt.date | None = None) -> Column:
    """NULL passes."""
    return F.col(c) > (F.current_date() if as_of is None else F.lit(as_of).cast("date"))


def is_outside(c: str, low, high) -> Column:
    """NULL passes."""
    return (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))


def is_blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def is_length_outside(c: str, low: int, high: int) -> Column:
    """NULL passes."""
    return (F.length(c) < low) | (F.length(c) > high)


def breaks_rule(rule: str) -> Column:
    """A rule that evaluates to NULL is broken."""
    return ~F.coalesce(F.expr(rule), F.lit(False))


def is_not_accepted(c: str, values: Sequence) -> Column:
    """NULL passes."""
    return ~F.col(c).isin(list(values))


# --- count adjustments ----------------------------------------------------


def over_tolerance(min_pct: float) -> Callable[[Column, Column], Column]:
    """Nothing up to the tolerated share of bad rows, then all of them."""

    def adjusted(bad: Column, total: Column) -> Column:
        share = F.try_divide(bad * F.lit(100.0), total)
        return F.when(F.coalesce(share, F.lit(0.0)) > 100.0 - min_pct, bad).otherwise(F.lit(0))

    return adjusted


def below_minimum(least: int) -> Callable[[Column, Column], Column]:
    """Number of rows that are lacking."""
    return lambda _bad, total: F.greatest(F.lit(least) - total, F.lit(0))


# --- set-level measures ---------------------------------------------------


def _result(violations: Column, total: Column) -> list[Column]:
    return [
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violation_count"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("row_count_total"),
    ]


def unique_rule(keys: Sequence[str]) -> GroupRule:
    """Rows in groups of more than one; NULL keys are a group."""
    return GroupRule(tuple(keys), lambda n, _flags, _dates: F.when(n > 1, n))


def fanout_rule(key: str, limit: int) -> GroupRule:
    """Keys with more than ``limit`` rows."""
    return GroupRule((key,), lambda n, _flags, _dates: F.when(n > limit, 1))


def exactly_one_rule(key: str, flag: str, date: str) -> GroupRule:
    """Ids without exactly one flagged row; none is right when all dates are NULL."""
    return GroupRule((key,), lambda _n, flags, dates: F.when(flags != F.when(dates > 0, 1).otherwise(0), 1), flag, date)


def grouped_counts(df: DataFrame, rule: GroupRule) -> DataFrame:
    """One rule by itself: violation_count and row_count_total."""
    return _fused(df, [Check("", "", group=rule)]).select("violation_count", "row_count_total")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grouped_counts(df, unique_rule(keys))


def orphaned(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose key is not in ``ref``; rows are counted per key before the join."""
    counts = df.groupBy(F.col(col).alias("_k")).agg(F.count("*").alias("_n"))
    known = ref.select(F.col(ref_col).alias("_r")).distinct()
    return counts.join(known, F.col("_k") == F.col("_r"), "left").agg(
        *_result(F.sum(F.when(F.col("_r").isNull(), F.col("_n"))), F.sum("_n"))
    )


def too_many_per_key(df: DataFrame, key: str, limit: int) -> DataFrame:
    return grouped_counts(df, fanout_rule(key, limit))


def not_exactly_one(df: DataFrame, key: str, flag: str, date: str) -> DataFrame:
    return grouped_counts(df, exactly_one_rule(key, flag, date))


def not_covered(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parent ids without any child row."""
    ids = parent.select(key).distinct()
    seen = child.select(F.col(key).alias("_k")).distinct()
    return ids.join(seen, F.col(key) == F.col("_k"), "left").agg(
        *_result(F.count_if(F.col("_k").isNull()), F.count("*"))
    )


def overlapping(df: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """Periods that overlap an earlier one of the same key."""
    bad = no_overlap_violations(df, on, start, end).agg(F.count("*").alias("_bad"))
    return df.agg(F.count("*").alias("_n")).select(*_result(bad.scalar(), F.col("_n")))


# --- constructors ---------------------------------------------------------


def expect_not_null(check_id, table, col, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_missing(col), **kw)


def expect_positive(check_id, table, col, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_not_positive(col), **kw)


def expect_completeness(check_id, table, col, min_pct=95.0, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_missing(col), adjust=over_tolerance(min_pct), **kw)


def expect_not_future(check_id, table, col, as_of=None, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_future(col, as_of), **kw)


def expect_between(check_id, table, col, low, high, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_outside(col, low, high), **kw)


def expect_not_blank(check_id, table, col, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_blank(col), **kw)


def expect_length(check_id, table, col, low=100, high=2500, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_length_outside(col, low, high), **kw)


def expect_sql(check_id, table, rule, **kw) -> Check:
    return Check(check_id, table, bad=lambda: breaks_rule(rule), **kw)


def expect_accepted(check_id, table, col, values, **kw) -> Check:
    return Check(check_id, table, bad=lambda: is_not_accepted(col, values), **kw)


def expect_row_count(check_id, table, least, **kw) -> Check:
    return Check(check_id, table, bad=lambda: F.lit(False), adjust=below_minimum(least), **kw)


def expect_unique(check_id, table, keys, **kw) -> Check:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Check(check_id, table, group=unique_rule(keys), **kw)


def expect_fk(check_id, table, col, ref_table, ref_col=None, **kw) -> Check:
    return Check(
        check_id, table, measure=lambda t: orphaned(t[table], col, t[ref_table], ref_col or col), **kw
    )


def expect_max_fanout(check_id, table, key, limit=200, **kw) -> Check:
    return Check(check_id, table, group=fanout_rule(key, limit), **kw)


def expect_exactly_one(check_id, table, key, flag, date, **kw) -> Check:
    return Check(check_id, table, group=exactly_one_rule(key, flag, date), **kw)


def expect_coverage(check_id, parent, child, key, **kw) -> Check:
    return Check(check_id, parent, measure=lambda t: not_covered(t[parent], t[child], key), **kw)


def expect_no_overlap(check_id, table, on, start, end, **kw) -> Check:
    return Check(check_id, table, measure=lambda t: overlapping(t[table], on, start, end), **kw)


# --- evaluation -----------------------------------------------------------


BITS = 60  # row-level checks noted in one mask of a row


def _fused(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Row-level checks and checks of groups of one table, one row per check, from one scan.

    The table is grouped by the keys of every rule, and by masks that say
    which row-level checks a row violates, as grouping sets of one aggregate:
    what is shuffled is a count per key or mask and task.
    """
    row_level = [c for c in checks if c.bad is not None]
    masks = []
    for first in range(0, len(row_level), BITS):
        bits = [F.when(c.bad(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, c in enumerate(row_level[first:first + BITS])]
        masks.append((f"_mask{first // BITS}", reduce(lambda a, b: a.bitwiseOR(b), bits)))
    sets = {tuple(name for name, _ in masks): None} if masks else {}
    by_keys = [tuple(sorted(set(c.group.keys))) if c.group else None for c in checks]
    sets = list(sets | dict.fromkeys(k for k in by_keys if k))
    columns = list(dict.fromkeys(c for names in sets for c in names))
    flags = list(dict.fromkeys(c.group.flag for c in checks if c.group and c.group.flag))
    dates = list(dict.fromkeys(c.group.date for c in checks if c.group and c.group.date))
    counts = [F.count("*").alias("_n"), *[F.count_if(F.col(f)).alias(f"_flag{i}") for i, f in enumerate(flags)],
              *[F.count(d).alias(f"_date{i}") for i, d in enumerate(dates)]]
    marked = df.withColumns(dict(masks)) if masks else df
    if len(sets) == 1:
        groups = marked.groupBy(*columns).agg(*counts)
        inside = [F.lit(True)]
    else:
        groups = marked.groupingSets([list(names) for names in sets], *columns).agg(F.grouping_id().alias("_set"), *counts)
        # A bit for each column of the list that a set leaves out, the last one lowest.
        numbers = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in names) for names in sets]
        inside = [F.col("_set") == x for x in numbers]
    n = F.col("_n")
    sums = [F.coalesce(F.sum(F.when(inside[0], n)), F.lit(0)).alias("_total")]
    for i, (c, keys) in enumerate(zip(checks, by_keys)):
        if keys is None:
            at = row_level.index(c)
            hit = F.col(f"_mask{at // BITS}").bitwiseAND(F.lit(1 << at % BITS)) != 0
            bad = F.when(inside[0] & hit, n)
        else:
            flag = F.col(f"_flag{flags.index(c.group.flag)}") if c.group.flag else F.lit(None)
            date = F.col(f"_date{dates.index(c.group.date)}") if c.group.date else F.lit(None)
            bad = F.when(inside[sets.index(keys)], c.group.violations(n, flag, date))
        sums.append(F.coalesce(F.sum(bad), F.lit(0)).alias(f"_c{i}"))
    total, rows = F.col("_total"), []
    for i, c in enumerate(checks):
        bad = F.col(f"_c{i}")
        rows.append(F.struct(*_labels(c), *_result(c.adjust(bad, total) if c.adjust else bad, total)))
    return groups.agg(*sums).select(F.inline(F.array(*rows)))


def _labels(c: Check) -> list[Column]:
    return [
        F.lit(c.check_id).alias("check_id"),
        F.lit(c.target_table).alias("target_table"),
        F.lit(c.layer).cast("string").alias("layer"),
        F.lit(c.severity).alias("severity"),
    ]


def check_results(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """One row per check: violations and rows, as one lazy DataFrame.

    Row-level checks and checks of groups of a table share one scan; those
    that compare two tables, or periods, have a plan of their own.
    """
    by_table: dict[str, list[Check]] = {}
    frames = []
    for c in checks:
        if c.measure is None:
            by_table.setdefault(c.target_table, []).append(c)
        else:
            frames.append(c.measure(tables).select(*_labels(c), "violation_count", "row_count_total"))
    frames += [_fused(tables[name], group) for name, group in by_table.items()]
    return union_all(frames)


# Fixed value: wording of a violation in the log.
VIOLATED = "{bad} of {total} rows violated this assertion"


def message() -> Column:
    wording = VIOLATED.format(bad="%d", total="%d")
    return F.format_string(wording, "violation_count", "row_count_total")


def violations_of(results: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """Violation log rows of evaluated checks."""
    return results.filter(F.col("violation_count") > 0).withColumns(
        {"message": message(), "run_id": F.lit(run_id), "checked_at": as_of.cast("timestamp")}
    )


def run_row(results: DataFrame, run_id: str, started: Column, finished: Column) -> DataFrame:
    """Run log row of evaluated checks."""
    failed = F.count_if(F.col("violation_count") > 0)
    return results.agg(
        F.lit(run_id).alias("run_id"),
        F.count("*").alias("checks_total"),
        (F.count("*") - failed).alias("checks_passed"),
        failed.alias("checks_failed"),
        started.cast("timestamp").alias("run_started_at"),
        finished.cast("timestamp").alias("run_finished_at"),
    )


def run_checks(spark: SparkSession, tables: Tables, checks: Sequence[Check], run_id: str):
    """Evaluate now; returns (violations, run) as DataFrames of the log layouts.

    A check that cannot be evaluated counts as one violation of 0 rows, and
    does not stop the others: when the fused job fails, checks run one by one.
    """
    started = dt.datetime.now(dt.timezone.utc)
    repeated = sorted(i for i, n in Counter(c.check_id for c in checks).items() if n > 1)
    if repeated:
        raise ValueError(f"check ids are used twice: {', '.join(repeated)}")
    rows, errors = [], {}
    planned = []
    for c in checks:
        try:
            check_results(tables, [c]).schema
            planned.append(c)
        except Exception as e:  # noqa: BLE001 - any failure is a result here
            errors[c.check_id] = e
    try:
        rows = check_results(tables, planned).collect() if planned else []
    except Exception:  # noqa: BLE001
        for c in planned:
            try:
                rows += check_results(tables, [c]).collect()
            except Exception as e:  # noqa: BLE001
                errors[c.check_id] = e
    finished = dt.datetime.now(dt.timezone.utc)
    found = []
    for r in rows:
        if r.violation_count > 0:
            text = VIOLATED.format(bad=r.violation_count, total=r.row_count_total)
            found.append((r.check_id, r.target_table, r.layer, r.severity, r.violation_count,
                          r.row_count_total, text, run_id, finished))
    for c in checks:
        if c.check_id in errors:
            error = errors[c.check_id]
            text = f"not evaluated on {c.target_table}: {type(error).__name__} {error}".strip()
            found.append((c.check_id, c.target_table, c.layer, c.severity, 1, 0, text, run_id, finished))
    # One row per check: bounded by the length of the check list.
    violations = spark.createDataFrame(found, TABLES["violations"])
    run = spark.createDataFrame(
        [(run_id, len(checks), len(checks) - len(found), len(found), started, finished)], TABLES["runs"]
    )
    return violations, run


def log_results(violations: DataFrame, run: DataFrame, violations_path: str, runs_path: str) -> None:
    ensure_schema(violations, TABLES["violations"]).coalesce(1).write.mode("append").parquet(violations_path)
    ensure_schema(run, TABLES["runs"]).coalesce(1).write.mode("append").parquet(runs_path)


def stopping(violations: DataFrame) -> DataFrame:
    """The checks of severity ``error`` in a violation log, each once, with their violations."""
    return (violations.filter(F.col("severity") == ERROR).groupBy("check_id", "target_table")
            .agg(F.sum("violation_count").alias("violation_count")))


def gate(violations: DataFrame) -> None:
    """Raise when a check of severity ``error`` failed; warnings pass."""
    failed = sorted({r.check_id for r in stopping(violations).select("check_id").collect()})
    if failed:
        raise AssertionError(f"stopped by checks of severity {ERROR!r} ({len(failed)}): {', '.join(failed)}")


def observe_checks(df: DataFrame, name: str, checks: Sequence[Check]) -> DataFrame:
    """Count row-level violations while ``df``, batch or stream, is being written."""
    row_level = [c for c in checks if c.bad is not None]
    return df.observe(
        name,
        F.count(F.lit(1)).alias("row_count_total"),
        *[F.count_if(c.bad()).alias(c.check_id) for c in row_level],
    )


def check_schema(df: DataFrame, columns: Sequence[Mapping]) -> list[str]:
    """Differences between a table and the columns of its contract."""
    names = {"BIGINT": "bigint", "INTEGER": "int", "INT": "int"}
    fields = {f.name: f for f in df.schema.fields}
    problems = []
    for column in columns:
        field = fields.pop(column["name"], None)
        if field is None:
            problems.append(f"{column['name']}: missing")
            continue
        wanted = names.get(column["type"].upper(), column["type"].lower())
        actual = field.dataType.simpleString()
        if actual != wanted:
            problems.append(f"{column['name']}: type {actual}, contract says {wanted}")
    problems += [f"{extra}: not in the contract" for extra in fields]
    return problems


def expect_schema(check_id: str, table: str, columns: Sequence[Mapping], extra: bool = False, **kw) -> Check:
    """As many violations as declared columns are missing or of another type.

    With ``extra``, columns of the table that are not declared (as those that
    its folders are named by) count too.
    """

    def measure(tables: Tables) -> DataFrame:
        df = tables[table]
        declared = {c["name"] for c in columns}
        seen = df if extra else df.select(*[c for c in df.columns if c in declared])
        problems = len(check_schema(seen, columns))
        return df.sparkSession.range(1).select(
            F.lit(problems).cast("bigint").alias("violation_count"),
            F.lit(len(columns)).cast("bigint").alias("row_count_total"))

    return Check(check_id, table, measure=measure, **kw)


def nullability_checks(table: str, columns: Sequence[Mapping], **kw) -> list[Check]:
    """Columns a contract declares as not nullable, as checks on the data.

    Parquet forgets NOT NULL, so the declared schema alone cannot tell.
    """
    return [
        expect_not_null(f"{table}__{c['name']}_declared_not_null", table, c["name"], **kw)
        for c in columns
        if not c.get("nullable", True)
    ]
