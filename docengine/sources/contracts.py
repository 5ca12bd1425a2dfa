"""Data contracts (YAML) -> checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from docengine.operators import expectations as ex

BUNDLED = Path(__file__).resolve().parent.parent / "contracts"


@dataclass(frozen=True)
class Contract:
    table: str
    columns: list[dict[str, Any]] = field(default_factory=list)
    expectations: list[dict[str, Any]] = field(default_factory=list)
    sla_hours: int | None = None
    layer: str | None = None
    timestamp_col: str | None = None

    def checks(self) -> list[ex.Check]:
        return [c for spec in self.expectations for c in _compile(self, spec)]

    def freshness_target(self) -> tuple[str, str, int]:
        return self.table, self.timestamp_col, self.sla_hours


def _columns(spec: dict[str, Any]) -> list[str]:
    return list(spec["columns"]) if "columns" in spec else [spec["column"]]


def _compile(contract: Contract, spec: dict[str, Any]) -> list[ex.Check]:
    kind, table = spec["type"], contract.table
    check_id = spec.get("id") or f"{table}__{kind}"
    kw = {"severity": spec.get("severity", ex.ERROR), "layer": contract.layer}
    if kind == "not_null":
        columns = _columns(spec)
        many = len(columns) > 1
        return [
            ex.expect_not_null(f"{check_id}__{c}" if many else check_id, table, c, **kw) for c in columns
        ]
    if kind == "fk_exists":
        ref_table, ref_col = spec["references"].rsplit(".", 1)
        return [ex.expect_fk(check_id, table, spec["column"], ref_table.rsplit(".", 1)[-1], ref_col, **kw)]
    build = {
        "positive": lambda: ex.expect_positive(check_id, table, spec["column"], **kw),
        "completeness_pct": lambda: ex.expect_completeness(
            check_id, table, spec["column"], float(spec["min_pct"]), **kw),
        "not_future": lambda: ex.expect_not_future(check_id, table, spec["column"], **kw),
        "between": lambda: ex.expect_between(check_id, table, spec["column"], spec["min"], spec["max"], **kw),
        "length": lambda: ex.expect_length(check_id, table, spec["column"], spec["min"], spec["max"], **kw),
        "not_blank": lambda: ex.expect_not_blank(check_id, table, spec["column"], **kw),
        "unique": lambda: ex.expect_unique(check_id, table, _columns(spec), **kw),
        "sql": lambda: ex.expect_sql(check_id, table, spec["expr"], **kw),
        "accepted_values": lambda: ex.expect_accepted(check_id, table, spec["column"], spec["values"], **kw),
        "row_count": lambda: ex.expect_row_count(check_id, table, int(spec["min"]), **kw),
        "max_fanout": lambda: ex.expect_max_fanout(check_id, table, spec["column"], int(spec["max"]), **kw),
        "exactly_one": lambda: ex.expect_exactly_one(
            check_id, table, spec["column"], spec["flag"], spec["date"], **kw),
        "no_overlap": lambda: ex.expect_no_overlap(
            check_id, table, _columns(spec), spec["start"], spec["end"], **kw),
        "coverage": lambda: ex.expect_coverage(check_id, table, spec["child"], spec["column"], **kw),
    }
    if kind not in build:
        raise ValueError(f"{table}: unknown expectation type {kind!r}")
    return [build[kind]()]


def parse_contract(doc: dict[str, Any]) -> Contract:
    table, sla = doc["table"], doc.get("sla", {})
    return Contract(
        table=table["name"],
        layer=table.get("schema"),
        timestamp_col=table.get("timestamp_col"),
        columns=doc.get("schema", {}).get("columns", []),
        expectations=doc.get("expectations", []),
        sla_hours=sla.get("freshness_hours"),
    )


def load_contract(path: str | Path) -> Contract:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse_contract(yaml.safe_load(f))


def bundled_contracts() -> list[Contract]:
    return [load_contract(p) for p in sorted(BUNDLED.glob("*.yaml"))]
