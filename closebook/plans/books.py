"""The reporting layers over one set of semantic tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.operators import gate, reports, skew, statement, tieout, views
from closebook.operators.assembly import calc_table, wide_table
from closebook.schemas import SemanticTables
from closebook.sources.tables import months_of

Keep = Callable[[DataFrame, str], DataFrame]


# The names by which a report asks for its source.
MODELS = {
    "CustodyBalancesByPeriod": "balances",
    "StakingRewardsByPeriod": "staking_rewards",
    "FeeAccrualsByPeriod": "fee_accruals",
    "ClientPeriodPositions": "client_positions",
    "ReconciliationSummary": "reconciliation",
    "LedgerBalanceTieOut": "tie_out",
    "MonthlyCustodyStatement": "monthly_statement",
}


class Books:
    """Lazy results of every layer; nothing runs until a result is used.

    ``keep`` is called on the intermediates that several results read: the hot keys, the balances, the
    reporting spine and, with a ``watch``, the reconciliation. By default they stay part of the plan; a close passes
    ``closebook.session.Scratch.keep``, so that the position snapshots are scanned once for the hot
    keys and once for the balances, however many results follow. Gate, statement and reports do not
    output invoice lists, so the spine is built without them, and the two results that have such a
    column join it.

    A first job counts positions by client. Unless a client may have more than ``hot_rows``, no key is hot: rows get no salt and are dealt by client alone, which serves all joins, sums and windows along the spine,
    and a statement finds the month before in one pass over the spine instead of joining it with itself.

    Where keys have more rows but the clients do not have more than a task takes (``skew.HOT_ROWS``), only the rows of hot keys
    go apart, by salts: ``_parts`` and what follows hold the rows of other keys, dealt by client, and those of hot keys.
    Small tables and watched closes do not go apart: there the second count is not worth it, or the layers are written whole.

    With a ``watch`` (and a ``keep`` that writes) the gate's checks are counted while balances, spine and
    reconciliation are written, so the gate itself reads nothing unless a check may fail. With a ``period``
    all results hold that month only, and no facts but those of the month and the one before are read.

    With ``prior_lists`` (and a ``keep`` that writes) a spine without hot keys is written with the month before beside each
    row, so the statement needs nothing but the rows as they are stored, however often it is read.
    """

    def __init__(
        self,
        tables: SemanticTables,
        entity: str = K.DEFAULT_ENTITY,
        run_ts: Column | None = None,
        hot_rows: int = skew.HOT_ROWS,
        keep: Keep = lambda df, name: df,
        watch: gate.Watch | None = None,
        period: date | None = None,
        prior_lists: bool = False,
    ) -> None:
        self.tables = tables if period is None else months_of(tables, period)
        self.entity = entity
        self.run_ts = run_ts
        self.hot_rows = hot_rows
        self.keep = keep
        self.watch = watch
        self.period = period
        self.prior_lists = prior_lists
        self._wide: dict[str, DataFrame] = {}

    @property
    def lookups(self) -> dict[str, DataFrame]:
        return {"ReferenceAssets": self.tables.ReferenceAssets}

    def _current(self, df: DataFrame, column: str = "PositionPeriod") -> DataFrame:
        """The rows of the closed month, or all."""
        return df if self.period is None else df.filter(self._is_current(column))

    def _is_current(self, column: str = "PositionPeriod") -> Column:
        return F.lit(True) if self.period is None else F.col(column) == F.lit(self.period)

    def _watched(self, df: DataFrame, *checks: gate.Check, **options: Column) -> DataFrame:
        return df if self.watch is None else self.watch.over(df, *checks, **options)

    def calc(self, table: str) -> DataFrame:
        return calc_table(self.tables[table], f"{table}Calc", self.lookups)

    def wide(self, table: str) -> DataFrame:
        if table not in self._wide:
            self._wide[table] = wide_table(self.tables[table], f"{table}Calc", self.lookups)
        return self._wide[table]

    @cached_property
    def hot(self) -> DataFrame:
        if self.apart:
            found = views.balance_keys(self._balances_with_fan.filter(F.col(skew.FAN).isNotNull()))
        else:
            found = views.hot_position_keys(self.wide("CustodyPositions"), min_rows=self.hot_rows)
        return self.keep(found, "hot-keys")

    @cached_property
    def even(self) -> bool:
        """Whether no client has very many positions."""
        present = self.tables.CustodyPositions.filter("ID IS NOT NULL AND CustomerId IS NOT NULL")
        return skew.all_small(present, "CustomerId", self.hot_rows)

    @cached_property
    def apart(self) -> bool:
        """Whether only the rows of hot keys are salted, as all rows of a client fit a task."""
        return self._rows_apart is not None

    @cached_property
    def _rows_apart(self) -> int | None:
        """The number of positions where no client has very many of them or of fees (whose invoices are listed by client then)."""
        if self.even or self.watch is not None or skew.surely_small(self.tables.CustodyPositions):
            return None
        known = "ID IS NOT NULL AND CustomerId IS NOT NULL"
        present = [table.filter(known).select("CustomerId") for table in (self.tables.CustodyPositions, self.tables.FeeEvents)]
        return skew.rows_if_small(present, "CustomerId", max(self.hot_rows, skew.HOT_ROWS))

    @cached_property
    def _deal(self) -> tuple[int | str, ...]:
        """How rows are dealt on the way to the spine and from it: by client (to tasks by their number, if known), or as each step needs."""
        if not self.apart:
            return ("CustomerId",) if self.even else ()
        tasks = skew.tasks_for(self.tables.CustodyPositions.sparkSession, self._rows_apart)
        return ("CustomerId",) if tasks is None else (tasks, "CustomerId")

    @property
    def _salts(self) -> DataFrame | None:
        return None if self.even else self.hot

    @cached_property
    def _balances_with_fan(self) -> DataFrame:
        found = views.balances_with_fan(self.wide("CustodyPositions"), self._deal, self.hot_rows)
        return skew.dealt(self.keep(found, "balances"), self._deal)

    def _parts(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of other keys, and rows of hot keys with their salts."""
        is_hot = F.col(skew.FAN).isNotNull()
        return df.filter(~is_hot).drop(skew.SALT, skew.FAN), df.filter(is_hot).drop(skew.FAN)

    @staticmethod
    def _whole(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
        """Both parts as one table with salts."""
        ordinary, hot = (part.drop(skew.FAN_BEFORE, skew.FAN_AFTER) for part in parts)
        return skew.stacked(ordinary.withColumn(skew.SALT, F.lit(0)), hot)

    def _dimensions(self, only: DataFrame | None = None) -> tuple[DataFrame, ...]:
        """What the spine joins, the sums of all keys or only of some hot ones."""
        rewards = skew.shared(views.staking_rewards(self.wide("StakingEvents"), self._deal, only))
        fees = skew.shared(views.fee_sums(self.wide("FeeEvents"), self._deal, only))
        return self.tables.Customers, self.tables.ReferenceAssets, rewards, fees

    @cached_property
    def _plain_positions(self) -> DataFrame:
        ordinary, _ = self._parts(self._balances_with_fan)
        return self.keep(views.client_positions(ordinary, *self._dimensions(), run_ts=self.run_ts, keep_salt=True), "client-positions")

    @cached_property
    def _position_parts(self) -> tuple[DataFrame, DataFrame]:
        _, hot = self._parts(self._balances_with_fan)
        salted = views.client_positions(hot, *self._dimensions(self.hot), run_ts=self.run_ts, hot=self.hot, keep_salt=True, only_hot=True)
        return self._plain_positions, self.keep(salted, "hot-client-positions")

    @cached_property
    def _reconciliation_parts(self) -> tuple[DataFrame, DataFrame]:
        totals = skew.shared(views.financial_event_totals(self.wide("FinancialEvents"), self._deal))
        plain, salted = (self._current(part) for part in self._position_parts)
        return (
            views.reconciliation_summary(skew.dealt(plain, self._deal), totals, self.entity, self.run_ts),
            views.reconciliation_summary(salted, totals, self.entity, self.run_ts, self.hot, keep_salt=True, only_hot=True),
        )

    def _parts_with_invoices(self, parts: tuple[DataFrame, DataFrame]) -> DataFrame:
        plain, salted = parts
        return self._whole((
            views.with_invoices(plain, self.invoice_lists, deal=self._deal),
            views.with_invoices(salted, self._lists(self.hot), self.hot, self._deal, only_hot=True),
        ))

    def _statement_apart(self) -> DataFrame:
        """Rows whose key is hot in neither of both months follow theirs in place, the others by a salted join.

        For that join the rows of hot keys and of the months beside them are salted together, the latter with one salt.
        """
        plain = skew.dealt(self._plain_positions, self._deal)
        followed = statement.monthly_statement(plain, self.entity, self.run_ts, even=True)
        is_hot, after_hot, before_hot = (F.col(name).isNotNull() for name in (skew.FAN, skew.FAN_BEFORE, skew.FAN_AFTER))
        touched = self._balances_with_fan.filter(is_hot | after_hot | before_hot)
        keys = self.keep(views.balance_keys(touched), "touched-keys")
        salted = views.client_positions(touched, *self._dimensions(keys), run_ts=self.run_ts, hot=keys, keep_salt=True, only_hot=True)
        salted = self.keep(skew.shared(salted), "touched-client-positions")
        prior = statement.prior_rows(statement.approved_only(salted))
        split = statement.monthly_statement(salted.filter(is_hot | after_hot), self.entity, self.run_ts, keys, prior=prior)
        return skew.stacked(followed, split)

    @cached_property
    def _salted_balances(self) -> DataFrame:
        if self.apart:
            return self._balances_with_fan
        balances = views.custody_balances(self.wide("CustodyPositions"), self._salts, keep_salt=True, even=self.even, deal=self._deal)
        balances = self._watched(balances, gate.ledger_tieout_clean(), failing=tieout.unmatched(), where=self._is_current())
        return self.keep(balances, "balances")

    @property
    def _salted_positions(self) -> DataFrame:
        return self._stored_positions.drop(statement.PRIOR)

    @cached_property
    def _stored_positions(self) -> DataFrame:
        if self.apart:
            return self._whole(self._position_parts)
        fees = self._watched(self.wide("FeeEvents"), gate.all_fees_billed(), where=self._is_current("FeeEventsCalc.FeePeriod"))
        customers = self._watched(self.tables.Customers, gate.kyc_approved_only(), where=F.col("IsActive"))
        spine = views.client_positions(
            skew.dealt(self._salted_balances, self._deal),
            customers,
            self.tables.ReferenceAssets,
            views.staking_rewards(self.wide("StakingEvents"), self._deal),
            views.fee_sums(fees, self._deal),
            run_ts=self.run_ts,
            hot=self._salts,
            keep_salt=True,
        )
        if self.prior_lists and self.even:
            spine = statement.with_prior_list(spine)
        return self.keep(spine, "client-positions")

    @cached_property
    def invoice_lists(self) -> DataFrame:
        return self._lists()

    def _lists(self, only: DataFrame | None = None) -> DataFrame:
        lines = views.invoice_lines(self.wide("FeeEvents"))
        return views.invoice_lists(lines, deal=self._deal, only=only) if self.apart else views.invoice_lists(lines)

    def _with_invoices(self, df: DataFrame) -> DataFrame:
        return views.with_invoices(df, self.invoice_lists, self._salts, self._deal)

    @property
    def balances(self) -> DataFrame:
        return self._current(views.unsalted(self._salted_balances))

    @cached_property
    def staking_rewards(self) -> DataFrame:
        return views.staking_rewards(self.wide("StakingEvents"))

    @cached_property
    def fee_accruals(self) -> DataFrame:
        return views.fee_accruals(self.wide("FeeEvents"))

    @property
    def client_positions(self) -> DataFrame:
        if self.apart:
            return self._current(views.unsalted(self._parts_with_invoices(self._position_parts)))
        return self._current(views.unsalted(self._with_invoices(self._salted_positions)))

    @cached_property
    def event_totals(self) -> DataFrame:
        return views.financial_event_totals(self.wide("FinancialEvents"))

    @cached_property
    def _salted_reconciliation(self) -> DataFrame:
        if self.apart:
            return self._whole(self._reconciliation_parts)
        events = self._watched(
            self.wide("FinancialEvents"), gate.no_pending_events(), where=self._is_current("FinancialEventsCalc.EventPeriod")
        )
        summary = views.reconciliation_summary(
            skew.dealt(self._current(self._salted_positions), self._deal), views.financial_event_totals(events, self._deal),
            self.entity, self.run_ts, self._salts, keep_salt=True,
        )
        if self.watch is None:
            return summary
        return self.keep(self._watched(summary, gate.reconciliation_clean(), gate.no_missing_positions()), "reconciliation")

    @property
    def reconciliation(self) -> DataFrame:
        if self.apart:
            return views.unsalted(self._parts_with_invoices(self._reconciliation_parts))
        return views.unsalted(self._with_invoices(self._salted_reconciliation))

    @cached_property
    def tie_out(self) -> DataFrame:
        return tieout.ledger_tie_out(self.balances, self.run_ts)

    @property
    def close_gate(self) -> DataFrame:
        """One row per check; with a ``watch`` the layers are written first."""
        summary = views.unsalted(self._salted_reconciliation)
        events = self._current(self.wide("FinancialEvents"), "FinancialEventsCalc.EventPeriod")
        fees = self._current(self.wide("FeeEvents"), "FeeEventsCalc.FeePeriod")
        if self.watch is None:
            return gate.period_close_gate(summary, self.tie_out, events, fees, self.tables.Customers)
        self.watch.exact(summary, gate.reconciliation_clean(), gate.no_missing_positions())
        self.watch.exact(self.tie_out, gate.ledger_tieout_clean())
        self.watch.exact(events, gate.no_pending_events())
        self.watch.exact(fees, gate.all_fees_billed())
        self.watch.exact(gate.active(self.tables.Customers), gate.kyc_approved_only())
        return self.watch.verdict(self.tables.Customers.sparkSession)

    @cached_property
    def monthly_statement(self) -> DataFrame:
        if self.apart:
            return self._current(self._statement_apart())
        return self._current(statement.monthly_statement(self._stored_positions, self.entity, self.run_ts, self._salts, even=self.even))

    def model(self, name: str) -> DataFrame:
        """The result that reports know by this name."""
        if name not in MODELS:
            raise ValueError(f"unknown source model {name!r}, known: {', '.join(MODELS)}")
        return getattr(self, MODELS[name])

    def report(self, config: Mapping[str, Any]) -> DataFrame:
        """A configured report over its ``source_model``, by default the monthly statement."""
        source = self.model(config.get("source_model", "MonthlyCustodyStatement"))
        return reports.report(config, reports.with_client_flags(source, self.tables.Customers))
