"""Checks, contracts, logs, gate, dashboards."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docengine.operators import expectations as ex
from docengine.operators import monitoring as mon
from docengine.sources.contracts import bundled_contracts, parse_contract
from conftest import plan_of, rows


def frame(spark):
    return spark.createDataFrame(
        [(1, "a", 0.5, dt.date(2024, 1, 1)), (2, None, 1.5, dt.date(2030, 1, 1)), (2, " ", None, None), (None, "b", -1.0, None)],
        "k INT, s STRING, x DOUBLE, d DATE",
    )


CASES = [
    (ex.expect_not_null("c", "t", "k"), 1),
    (ex.expect_positive("c", "t", "x"), 2),
    (ex.expect_not_future("c", "t", "d", "2024-06-01"), 1),
    (ex.expect_between("c", "t", "x", 0.0, 1.0), 2),
    (ex.expect_not_blank("c", "t", "s"), 2),
    (ex.expect_length("c", "t", "s", 1, 1), 0),
    (ex.expect_sql("c", "t", "x > 0"), 2),
    (ex.expect_accepted("c", "t", "s", ["a", "b"]), 1),
    (ex.expect_row_count("c", "t", 10), 6),
    (ex.expect_row_count("c", "t", 4), 0),
    (ex.expect_unique("c", "t", "k"), 2),
    (ex.expect_fk("c", "t", "k", "ref", "id"), 3),
    (ex.expect_max_fanout("c", "t", "k", 1), 1),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_each_check(spark, case):
    check, wanted = CASES[case]
    tables = {"t": frame(spark), "ref": spark.createDataFrame([(1,), (1,)], "id INT")}
    row = ex.check_results(tables, [check]).first()
    assert (row.violation_count, row.row_count_total) == (wanted, 4)


@pytest.mark.parametrize("missing, total, wanted", [(5, 100, 0), (6, 100, 6), (0, 0, 0), (1, 1, 1)])
def test_completeness(spark, missing, total, wanted):
    df = spark.range(total).select(F.when(F.col("id") >= missing, F.col("id")).alias("c"))
    row = ex.check_results({"t": df}, [ex.expect_completeness("c", "t", "c", 95.0)]).first()
    assert (row.violation_count, row.row_count_total) == (wanted, total)


def test_unique_counts_all_rows_of_repeated_groups(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"] + [(None,), (None,)], "k STRING")
    assert ex.repeated(df, ["k"]).first().violation_count == 7


def test_exactly_one_and_coverage(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", True, d), ("a", True, d), ("b", True, d), ("b", False, d), ("c", False, None),
                                ("d", False, d)], "k STRING, f BOOLEAN, d DATE")
    assert ex.not_exactly_one(df, "k", "f", "d").first().violation_count == 2
    child = spark.createDataFrame([("a",), ("a",)], "k STRING")
    assert tuple(ex.not_covered(df, child, "k").first()) == (3, 4)


def test_row_level_checks_share_one_scan(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    checks = [ex.expect_not_null("a", "t", "l_tax"), ex.expect_positive("b", "t", "l_discount"),
              ex.expect_between("c", "t", "l_tax", 0, 1)]
    assert plan_of(ex.check_results({"t": lines}, checks)).count("ReadSchema") == 1


def test_runner_survives_a_check_that_raises(spark, tmp_path):
    checks = [
        ex.expect_not_null("fine", "t", "s", severity="warn"),
        ex.expect_not_null("no table", "nowhere", "s"),
        ex.expect_not_null("no column", "t", "nope"),
        ex.expect_sql("fails late", "t", "CAST(concat('n', s) AS INT) > 0"),
        ex.expect_length("passes", "t", "s", 1, 1),
    ]
    violations, run = ex.run_checks(spark, {"t": frame(spark)}, checks, "r1")
    got = {r.check_id: (r.violation_count, r.row_count_total) for r in violations.collect()}
    assert got == {"fine": (1, 4), "no table": (1, 0), "no column": (1, 0), "fails late": (1, 0)}
    assert tuple(run.select("checks_total", "checks_passed", "checks_failed").first()) == (5, 1, 4)
    v, r = str(tmp_path / "v"), str(tmp_path / "r")
    for _ in range(2):
        ex.log_results(violations, run, v, r)
    assert spark.read.parquet(v).count() == 8 and spark.read.parquet(r).count() == 2
    with pytest.raises(AssertionError, match=r"severity .error. \(3\)"):
        ex.gate(violations)
    ex.gate(violations.filter("severity = 'warn'"))


def test_observed_counts(spark, tmp_path):
    from pyspark.sql import Observation

    watch = Observation("inline")
    df = frame(spark)
    checks = [ex.expect_not_null("k", "t", "k"), ex.expect_not_blank("s", "t", "s")]
    counts = [F.count_if(c.bad()).alias(c.check_id) for c in checks]
    df.observe(watch, *counts).write.parquet(str(tmp_path / "a"))
    assert watch.get == {"k": 1, "s": 2}
    assert ex.observe_checks(df, "x", checks).count() == 4


CONTRACT = {
    "table": {"name": "t", "schema": "gold", "timestamp_col": "ts"},
    "sla": {"freshness_hours": 4},
    "schema": {"columns": [{"name": "k", "type": "INT", "nullable": False}, {"name": "s", "type": "STRING"},
                           {"name": "x", "type": "BIGINT"}, {"name": "gone", "type": "DATE"}]},
    "expectations": [
        {"type": "not_null", "columns": ["k", "s"]},
        {"id": "u", "type": "unique", "columns": ["k"], "severity": "warn"},
        {"id": "fk", "type": "fk_exists", "column": "k", "references": "gold.ref.id"},
        {"id": "rule", "type": "sql", "expr": "x IS NULL OR x < 2"},
    ],
}


def test_contract_compiles_to_checks(spark):
    contract = parse_contract(CONTRACT)
    tables = {"t": frame(spark), "ref": spark.createDataFrame([(1,)], "id INT")}
    got = {r.check_id: r.violation_count for r in ex.check_results(tables, contract.checks()).collect()}
    assert got == {"t__not_null__k": 1, "t__not_null__s": 1, "u": 2, "fk": 3, "rule": 0}
    assert ex.check_schema(tables["t"], contract.columns) == [
        "x: type double, contract says bigint", "gone: missing", "d: not in the contract"]
    declared = ex.nullability_checks("t", contract.columns)
    assert [c.check_id for c in declared] == ["t__k_declared_not_null"]
    assert contract.freshness_target() == ("t", "ts", 4)
    with pytest.raises(ValueError):
        parse_contract({**CONTRACT, "expectations": [{"type": "huh"}]}).checks()


def test_bundled_contracts_cover_the_declared_tables(spark):
    from docengine.schemas import TABLES, empty

    stored = {"drug_label_raw": "raw", "drug_label_extracted": "extracted", "dim_drug": "dim",
              "fact_adverse_events": "fact", "drug_label_chunks": "chunks"}
    contracts = {c.table: c for c in bundled_contracts()}
    assert set(contracts) == set(stored)
    tables = {t: empty(spark, TABLES[s]) for t, s in stored.items()}
    for name, contract in contracts.items():
        assert ex.check_schema(tables[name], contract.columns) == []
    checks = [c for contract in contracts.values() for c in contract.checks()]
    failing = {r.check_id for r in ex.check_results(tables, checks).collect() if r.violation_count}
    assert failing == {"dim_drug__row_count"}


def test_freshness(spark):
    as_of = "2024-01-02 00:00:36"
    when = {"at": "2024-01-01 00:00:36", "over": "2024-01-01 00:00:00", "none": None}
    tables = {k: spark.createDataFrame([(v,)], "ts STRING").select(F.col("ts").cast("timestamp")) for k, v in when.items()}
    got = mon.freshness(spark, tables, [(k, "ts", 24) for k in when], as_of)
    assert {r.table_path: r.sla_status for r in got.collect()} == {"at": "ok", "over": "BREACH", "none": "no_data"}


def test_costs_are_exact(spark):
    usage = spark.createDataFrame(
        [("s", "2024-01-10 10:00:00", 0.005, "docs-load-dev")] * 3 + [("s", "2024-01-10 10:00:00", 5.0, "other")]
        + [("s", "2023-01-10 10:00:00", 5.0, "docs-load-dev"), ("s", "2024-01-11 00:00:00", 1.0, None)],
        "sku_name STRING, t STRING, usage_quantity DOUBLE, job STRING",
    ).select("sku_name", F.col("t").cast("timestamp").alias("usage_start_time"), "usage_quantity",
             F.create_map(F.lit("job_name"), F.col("job")).alias("custom_tags"))
    prices = spark.createDataFrame(
        [("s", "USD", 1.0, "2020-01-01", None), ("s", "EUR", 9.0, "2020-01-01", None)],
        "sku_name STRING, currency_code STRING, list_price DOUBLE, a STRING, b STRING",
    ).select("sku_name", "currency_code", "list_price", F.col("a").cast("timestamp").alias("price_start_time"),
             F.col("b").cast("timestamp").alias("price_end_time"))
    by_job = mon.cost_by_job(usage, prices, "docs-", 14, "2024-01-15 08:00:00")
    assert [tuple(r)[1:] for r in by_job.collect()] == [("docs-load-dev", 0.02, 0.02)]
    stage = mon.cost_by_stage(usage, prices, "docs-", r"^docs-([a-z]+)-", 14, "2024-01-15 08:00:00")
    assert rows(stage) == [("load", 0.02, 0.02)]


def test_pass_rate_of_a_day_without_checks(spark):
    runs = spark.createDataFrame([("2024-01-01", 0, 0, 0), ("2024-01-02", 3, 2, 1)],
                                 "run_started_at STRING, checks_total BIGINT, checks_passed BIGINT, checks_failed BIGINT")
    got = [r.pass_rate_pct for r in mon.pass_rate(runs).collect()]
    assert float(got[0]) == 66.7 and got[1] is None


def test_checks_of_rows_and_groups_share_one_scan(spark, tmp_path):
    """Grouping sets with NULL keys, shared keys, more than one mask, against each check by itself."""
    rows_in = [(None, 1, "a", True, "d"), (None, 1, "b", False, None), (1, 1, None, True, None), (1, None, "a", True, "d"),
               (2, None, "", False, "d"), (3, 2, "c", False, None), (3, 2, "c", None, None)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows_in, "k INT, x INT, s STRING, f BOOLEAN, d STRING").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [ex.expect_not_null("k0", "t", "k"), ex.expect_unique("u1", "t", ["k", "x"]),
              ex.expect_unique("u2", "t", ["x", "k"]), ex.expect_unique("u3", "t", "s"), ex.expect_max_fanout("m", "t", "k", 1),
              ex.expect_exactly_one("one", "t", "k", "f", "d"), ex.expect_row_count("least", "t", 9),
              ex.expect_completeness("share", "t", "s", 95.0)]
    checks += [ex.expect_sql(f"sql{i}", "t", f"x <= {i % 3}") for i in range(70)]
    together = ex.check_results({"t": df}, checks)
    assert plan_of(together).count("ReadSchema") == 1
    got = {r.check_id: (r.violation_count, r.row_count_total) for r in together.collect()}
    alone = {c.check_id: tuple(ex.check_results({"t": df}, [c]).select("violation_count", "row_count_total").first())
             for c in checks[:12]}
    assert {c: got[c] for c in alone} == alone and len(got) == 78
    assert {c: v for c, (v, _) in got.items() if not c.startswith("sql")} == {
        "k0": 2, "u1": 4, "u2": 4, "u3": 4, "m": 3, "one": 2, "least": 2, "share": 1}
    assert [got[f"sql{i}"][0] for i in (0, 1, 2, 66, 67, 68)] == [7, 4, 2, 7, 4, 2]
    assert {t for _, t in got.values()} == {7}
    none = {r.check_id: r.violation_count for r in ex.check_results({"t": df.limit(0)}, checks).collect()}
    assert none["least"] == 9 and sum(none.values()) == 9
