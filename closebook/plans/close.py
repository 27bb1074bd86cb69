"""The month-end close: build, check, and only then export."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.operators import reports, views
from closebook.operators.gate import Watch, require_green
from closebook.operators.reports import CUSTODY_MONTHLY
from closebook.operators.skew import HOT_ROWS
from closebook.operators.statement import DERIVED
from closebook.plans.books import Books
from closebook.schemas import SemanticTables
from closebook.session import Scratch, configure
from closebook.sources.delivery import deliver_report, destination, export_statements, record_deliveries
from closebook.sources.tables import read_months, replace_month

# The tables of the books that a close of one month brings up to date.
MONTHLY = {
    "CustodyBalancesByPeriod": "balances",
    "ClientPeriodPositions": "client_positions",
    "ReconciliationSummary": "reconciliation",
    "LedgerBalanceTieOut": "tie_out",
    "MonthlyCustodyStatement": "monthly_statement",
}


@dataclass(frozen=True)
class CloseResult:
    period: date
    checks: list
    exported_to: str
    delivered_to: str | None = None


def statement_period(run_date: date) -> date:
    """First day of the month before the run."""
    return (run_date.replace(day=1) - timedelta(days=1)).replace(day=1)


def _timestamp(run_at: datetime) -> Column:
    return F.lit(run_at.isoformat(sep=" ")).cast("timestamp")


def _deliver(books: Books, statement: DataFrame, config: Mapping[str, Any], root: str, period: date, log: str | None, run_ts: Column) -> str:
    """The report's files of one month, and the log of the statements that are in them."""
    source = reports.with_client_flags(statement, books.tables.Customers)
    deliver_report(config, source, root, period)
    if log:
        sent = reports.filter_clients(source, config.get("client_filters", [])).filter(F.col("PositionPeriod") == F.lit(period))
        record_deliveries(sent, log, run_ts)
    return destination(config, root, period)


def close_period(
    tables: SemanticTables,
    run_at: datetime,
    export_folder: str,
    delivery_log: str | None = None,
    entity: str = K.DEFAULT_ENTITY,
    hot_rows: int = HOT_ROWS,
    report: Mapping[str, Any] | None = None,
    report_root: str | None = None,
) -> CloseResult:
    """Close the month before ``run_at``; raises PeriodCloseFailed, and exports nothing, unless all checks pass.

    Balances, spine and reconciliation are written once, and the checks are counted on the way. With a ``report_root``
    the closed month's rows of ``report`` (by default the custody report) also go to one file per client below it,
    and the log holds the statements in these files; without, it holds all of them.
    """
    configure(tables.Customers.sparkSession)
    run_ts = _timestamp(run_at)
    with Scratch(tables.Customers.sparkSession) as scratch:
        books = Books(tables, entity, run_ts, hot_rows, keep=scratch.keep, watch=Watch(), prior_lists=True)
        checks = require_green(books.close_gate)
        period = statement_period(run_at.date())
        target = export_statements(books.monthly_statement, export_folder, period, DERIVED)
        sent = None
        if report_root:
            sent = _deliver(books, books.monthly_statement, report or CUSTODY_MONTHLY, report_root, period, delivery_log, run_ts)
        elif delivery_log:
            record_deliveries(books.monthly_statement, delivery_log, run_ts)
    return CloseResult(period, checks, target, sent)


def close_month(
    spark: SparkSession,
    location: str,
    period: date,
    run_at: datetime,
    books_folder: str,
    report_root: str | None = None,
    delivery_log: str | None = None,
    entity: str = K.DEFAULT_ENTITY,
    hot_rows: int = HOT_ROWS,
    report: Mapping[str, Any] = CUSTODY_MONTHLY,
) -> CloseResult:
    """Close one month of tables that are stored by month, and put its results in the place of that month's in the books.

    Of the facts only the month's files, and those of positions and rewards of the month before, are opened. The
    checks look at the month alone (and at all clients), and raise PeriodCloseFailed before anything
    is changed. Then the month's partition of each table of ``MONTHLY`` is replaced, whether it was closed
    before or not; other months stay as they are. The report's files and the log follow as in :func:`close_period`.
    """
    configure(spark)
    period, run_ts = period.replace(day=1), _timestamp(run_at)
    tables = read_months(spark, location, period)
    with Scratch(spark) as scratch:
        books = Books(tables, entity, run_ts, hot_rows, keep=scratch.keep, watch=Watch(), period=period, prior_lists=True)
        checks = require_green(books.close_gate)
        statement = scratch.keep(books.monthly_statement, "statement")
        for name, attribute in MONTHLY.items():
            rows = statement if attribute == "monthly_statement" else getattr(books, attribute)
            replace_month(views.unsalted(rows), f"{books_folder.rstrip('/')}/{name}", period)
        sent = None
        if report_root:
            sent = _deliver(books, statement, report, report_root, period, delivery_log, run_ts)
        elif delivery_log:
            record_deliveries(statement, delivery_log, run_ts)
    return CloseResult(period, checks, books_folder, sent)
