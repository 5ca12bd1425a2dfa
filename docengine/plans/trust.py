"""Daily job: run the contracts, log the results, stop on errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from docengine.operators import expectations as ex
from docengine.operators.monitoring import freshness
from docengine.sources.contracts import Contract, bundled_contracts


def declared_checks(contract: Contract, tables: Mapping[str, DataFrame]) -> list[ex.Check]:
    """Checks of the declared columns: NOT NULL ones on the data, names and types on the schema."""
    if not contract.columns or contract.table not in tables:
        return []
    present = set(tables[contract.table].columns)
    tested = {c.check_id for c in contract.checks()}
    declared = [c for c in contract.columns if c["name"] in present]
    checks = [c for c in ex.nullability_checks(contract.table, declared, layer=contract.layer) if c.check_id not in tested]
    return [ex.expect_schema(f"{contract.table}__declared_schema", contract.table, contract.columns,
                             layer=contract.layer), *checks]


def run_contracts(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    run_id: str,
    violations_path: str,
    runs_path: str,
    contracts: Sequence[Contract] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Evaluate every expectation, append both logs, then raise on errors."""
    contracts = bundled_contracts() if contracts is None else contracts
    checks = [c for contract in contracts for c in [*contract.checks(), *declared_checks(contract, tables)]]
    violations, run = ex.run_checks(spark, tables, checks, run_id)
    ex.log_results(violations, run, violations_path, runs_path)
    ex.gate(violations)
    return violations, run


def contract_freshness(spark: SparkSession, tables: Mapping[str, DataFrame],
                       contracts: Sequence[Contract] | None = None, as_of=None) -> DataFrame:
    contracts = bundled_contracts() if contracts is None else contracts
    targets = [c.freshness_target() for c in contracts if c.sla_hours and c.timestamp_col]
    return freshness(spark, tables, targets, as_of)
