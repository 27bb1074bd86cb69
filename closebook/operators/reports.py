"""Reports defined by a configuration instead of code.

A configuration is a mapping with ``client_filters``, ``columns``, ``status`` and, for reports that are
sent, ``delivery``; it may be written in Python or loaded from a YAML file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.operators.skew import broadcast_if_small

DEFAULT_ORDER = 99
SORT_COLUMNS = ("CustomerName", "PositionPeriod", "Symbol")
CLIENT_FLAGS = ("KycStatus", "IsActive")

# The monthly custody report.
CUSTODY_MONTHLY: dict[str, Any] = {
    "report_id": "custody_monthly",
    "display_name": "Monthly Custody Statement",
    "status": "active",
    "source_model": "MonthlyCustodyStatement",
    "client_filters": [
        {"field": "KycStatus", "operator": "equals", "value": "APPROVED"},
        {"field": "IsActive", "operator": "equals", "value": True},
        {
            "field": "CustomerType",
            "operator": "in",
            "values": ["INSTITUTIONAL", "HEDGE_FUND", "ASSET_MANAGER", "PENSION_FUND"],
        },
    ],
    "columns": [
        {"name": "PeriodLabel", "label": "Statement Period", "order": 1},
        {"name": "CustomerName", "label": "Client Name", "order": 2},
        {"name": "Symbol", "label": "Asset", "order": 3},
        {"name": "AssetName", "label": "Asset Name", "order": 4},
        {"name": "PeriodEndQuantity", "label": "Quantity Held", "order": 5},
        {"name": "PeriodEndPriceUSD", "label": "Price (USD)", "order": 6},
        {"name": "PeriodEndValuationUSD", "label": "Market Value (USD)", "order": 7},
        {"name": "QuantityChangePeriodOverPeriod", "label": "Quantity Change (MoM)", "order": 8},
        {"name": "ValuationChangePeriodOverPeriodUSD", "label": "Value Change (MoM, USD)", "order": 9},
        {"name": "ValuationChangePctPeriodOverPeriod", "label": "Value Change (MoM, %)", "order": 10},
        {
            "name": "SettledNetRewards",
            "label": "Settled Staking Rewards (USD)",
            "order": 11,
            "include_if": "IsStakeable = true",
        },
        {
            "name": "NetPendingRewards",
            "label": "Pending Rewards (USD)",
            "order": 12,
            "include_if": "IsStakeable = true",
        },
        {"name": "TotalPositionValueWithNetpenUSD", "label": "Total Economic Exposure (USD)", "order": 13},
        {"name": "TotalFeesUSD", "label": "Fees Charged (USD)", "order": 14},
        {"name": "CustodianLedgerRef", "label": "Custodian Reference", "order": 15},
        {
            "name": "StatementId",
            "label": "Statement ID",
            "order": 16,
            "note": "Unique ID for this statement row — used as delivery idempotency key",
        },
    ],
    "delivery": {
        "format": "csv",
        "filename_template": "custody_statement_{client_id}_{period}.csv",
        "destination_path": "/statements/custody/monthly/{period}/",
    },
}


def load_reports(folder: str, report_id: str | None = None) -> list[dict]:
    """Active report configurations of a folder of YAML files, in file name order."""
    import yaml  # optional: only needed for configurations kept as files

    configs = [yaml.safe_load(path.read_text()) for path in sorted(Path(folder).glob("*.yml"))]
    active = [config for config in configs if config.get("status") == "active"]
    return [config for config in active if report_id in (None, config.get("report_id"))]


def condition(rule: Mapping[str, Any]) -> Column:
    """One client filter as a boolean column."""
    field, operator = F.col(rule["field"]), rule["operator"]
    if operator == "equals":
        return field == F.lit(rule["value"])
    if operator == "not_equals":
        return field != F.lit(rule["value"])
    if operator == "in":
        return field.isin([str(value) for value in rule["values"]])
    raise ValueError(f"unknown filter operator {operator!r} on {rule['field']}")


def filter_clients(source: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows meeting every rule; no rules keep everything."""
    return source.filter(reduce(and_, map(condition, rules))) if rules else source


def _column(spec: Mapping[str, Any]) -> Column:
    value = F.col(spec["name"])
    if spec.get("include_if"):
        flag = spec["include_if"].split("=")[0].strip()
        value = F.when(F.col(flag), value)
    label = spec.get("label", spec["name"])
    comment = f"{label}. {spec['note']}" if spec.get("note") else label
    return value.alias(spec["name"], metadata={"comment": comment})


def project(source: DataFrame, columns: Sequence[Mapping[str, Any]]) -> DataFrame:
    """The configured columns by their order, with label and note as column comments."""
    ordered = sorted(columns, key=lambda spec: spec.get("order", DEFAULT_ORDER))
    return source.select(*[_column(spec) for spec in ordered])


def rows(config: Mapping[str, Any], source: DataFrame, carried: Mapping[str, str]) -> DataFrame:
    """The unordered rows of a report, with columns of the source beside them that the report itself does not show.

    ``carried`` maps such a column to the name it gets.
    """
    ordered = sorted(config.get("columns", []), key=lambda spec: spec.get("order", DEFAULT_ORDER))
    kept = filter_clients(source, config.get("client_filters", []))
    return kept.select(*[F.col(name).alias(new) for name, new in carried.items()], *[_column(spec) for spec in ordered])


def report(config: Mapping[str, Any], source: DataFrame) -> DataFrame:
    """Filter, sort and project a source as configured."""
    rows = filter_clients(source, config.get("client_filters", []))
    order = [name for name in SORT_COLUMNS if name in source.columns]
    return project(rows.orderBy(*order) if order else rows, config.get("columns", []))


def with_client_flags(source: DataFrame, customers: DataFrame) -> DataFrame:
    """A source plus the two client columns that reports filter on, where it lacks them and names the client."""
    missing = [name for name in CLIENT_FLAGS if name not in source.columns]
    if not missing or "CustomerId" not in source.columns:
        return source
    flags = customers.select("CustomerId", *missing)
    return source.join(broadcast_if_small(flags), "CustomerId", "left")
