"""The reporting layers over catalog tables that are bucketed by client, or by client, asset and month.

Balances, monthly sums, the reporting spine and what the next month's statement needs of it are stored once in equally many
buckets. So the joins of the spine to rewards, fees and event totals, and its join with the month before, find both sides
where they are needed and exchange nothing, however often statements and reports are made.

Where no client has very many positions, buckets are made of clients. Then the tables are written from rows that were
dealt to buckets once, as they were read, and the clients' attributes join in place too.

Where keys have more rows than asked for and clients no more than a task takes, buckets are made of clients too. Balances
are stored with the number of salts of their key and of its neighbours in time, so the few rows that go by salts are told
by these columns.

Else buckets are made of all three columns. Keys with very many rows (see :mod:`closebook.operators.skew`) would each lie in
one bucket. Their rows are kept in a table of their own and joined with salts, as :class:`closebook.plans.books.Books` does
for all rows.
"""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.operators import skew, statement, views
from closebook.operators.skew import FAN_AFTER, FAN_BEFORE, SALT
from closebook.operators.views import KEYS
from closebook.plans.books import Books
from closebook.schemas import SemanticTables
from closebook.sources.tables import store_bucketed



class BucketedBooks(Books):
    """Books that store what several results join as tables ``<prefix>_<name>``, and replace them when they exist.

    ``prefix`` may name a database (``books.y2025``). ``buckets`` should let a bucket of the spine fit a task, that is
    some hundred MB; all tables have the same number, or joins would have to exchange one side. With a ``location``
    the files lie in folders below it, else in the warehouse. A store takes place when a result is first asked for.
    """

    def __init__(self, tables: SemanticTables, prefix: str, buckets: int, location: str | None = None, **options: Any) -> None:
        if options.get("watch") is not None:
            raise ValueError("a watched close writes its layers itself")
        super().__init__(tables, **options)
        self.prefix, self.buckets, self.location = prefix, buckets, location

    @property
    def _deal(self) -> tuple[int | str, ...]:
        return (self.buckets, "CustomerId") if self.even or self.apart else ()

    def _stored(self, df: DataFrame, name: str, month: str = "PositionPeriod") -> DataFrame:
        table = f"{self.prefix}_{name}"
        path = None if self.location is None else f"{self.location.rstrip('/')}/{name}"
        by = ("CustomerId",) if self._deal else ("CustomerId", "AssetId", month)
        return store_bucketed(df, table, by, self.buckets, path)

    def _by_heat(self, df: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows whose key is not among some few, and those whose key is."""
        few = F.broadcast(keys.select(*KEYS))
        return df.join(few, list(KEYS), "left_anti"), df.join(few, list(KEYS), "left_semi")

    def _united(self, ordinary: DataFrame, hot: DataFrame | None) -> DataFrame:
        """Both parts; without hot keys rows have no salt."""
        return ordinary if hot is None else ordinary.withColumn(SALT, F.lit(0)).unionByName(hot)

    @cached_property
    def _balances(self) -> tuple[DataFrame, DataFrame | None]:
        """Balances of ordinary keys (bucketed), and those of hot keys, if there may be any, with their salts."""
        if self.even:
            return self._stored(views.custody_balances(self.wide("CustodyPositions"), even=True, deal=self._deal), "balances"), None
        if self.apart:
            return self._parts(self._balances_with_fan)
        balances = views.custody_balances(self.wide("CustodyPositions"), self.hot, keep_salt=True)
        ordinary, hot = self._by_heat(self.keep(balances, "balances"), self.hot)
        return self._stored(views.unsalted(ordinary), "balances"), hot

    @cached_property
    def _balances_with_fan(self) -> DataFrame:
        return self._stored(views.balances_with_fan(self.wide("CustodyPositions"), self._deal, self.hot_rows), "balances")

    @cached_property
    def _salted_balances(self) -> DataFrame:
        return self._united(*self._balances)

    @cached_property
    def staking_rewards(self) -> DataFrame:
        return self._stored(views.staking_rewards(self.wide("StakingEvents"), self._deal), "staking_rewards", "RewardPeriod")

    @cached_property
    def _fee_sums(self) -> DataFrame:
        return self._stored(views.fee_sums(self.wide("FeeEvents"), self._deal), "fee_sums", "FeePeriod")

    @cached_property
    def event_totals(self) -> DataFrame:
        return self._stored(views.financial_event_totals(self.wide("FinancialEvents"), self._deal), "event_totals", "EventPeriod")

    @cached_property
    def spine(self) -> tuple[DataFrame, DataFrame | None]:
        """The reporting spine: rows of ordinary keys (bucketed), and rows of hot keys with their salts."""
        ordinary, hot = self._balances
        dimensions = (self.tables.Customers, self.tables.ReferenceAssets, self.staking_rewards, self._fee_sums)
        plain = views.client_positions(ordinary, *dimensions, run_ts=self.run_ts, keep_salt=True)
        stored = self._stored(plain, "client_positions")
        if hot is None:
            return stored, None
        salted = views.client_positions(hot, *dimensions, run_ts=self.run_ts, hot=self.hot, keep_salt=True, only_hot=self.apart)
        return stored, self.keep(salted, "hot-client-positions")

    @property
    def _position_parts(self) -> tuple[DataFrame, DataFrame]:
        return self.spine

    @cached_property
    def _salted_positions(self) -> DataFrame:
        return self._united(*self.spine)

    @cached_property
    def _reconciliation_parts(self) -> tuple[DataFrame, DataFrame | None]:
        ordinary, hot = (part if part is None else self._current(part) for part in self.spine)
        whole = views.reconciliation_summary(ordinary, self.event_totals, self.entity, self.run_ts)
        if hot is None:
            return whole, None
        salted = views.reconciliation_summary(
            hot, self.event_totals, self.entity, self.run_ts, self.hot, keep_salt=True, only_hot=self.apart
        )
        return whole, salted

    @cached_property
    def _salted_reconciliation(self) -> DataFrame:
        return self._united(*self._reconciliation_parts)

    @cached_property
    def _prior(self) -> tuple[DataFrame, DataFrame | None]:
        """What the next month's statements need of the spine's two parts."""
        ordinary, hot = (part if part is None else statement.prior_rows(statement.approved_only(part), self.apart) for part in self.spine)
        return self._stored(ordinary, "prior_positions"), hot

    @cached_property
    def monthly_statement(self) -> DataFrame:
        """Rows whose key is hot in neither of both months meet in their bucket, the others by salted joins."""
        (ordinary, hot), (prior, hot_prior) = self.spine, self._prior
        if hot is None:
            return self._current(statement.monthly_statement(ordinary, self.entity, self.run_ts, prior=prior))
        if self.apart:
            alone, alone_prior = ordinary.filter(F.col(FAN_BEFORE).isNull()), prior.filter(F.col(FAN_AFTER).isNull())
            met = statement.monthly_statement(alone, self.entity, self.run_ts, prior=alone_prior.drop(FAN_AFTER))
            salted = ordinary.filter(F.col(FAN_BEFORE).isNotNull()).withColumn(SALT, F.lit(0)).unionByName(hot)
            before = prior.filter(F.col(FAN_AFTER).isNotNull()).unionByName(hot_prior).drop(FAN_AFTER)
            return self._current(met.unionByName(statement.monthly_statement(salted, self.entity, self.run_ts, self.hot, prior=before)))
        following = self.hot.withColumn("PositionPeriod", F.add_months("PositionPeriod", 1))
        touched = self.hot.select(*KEYS).union(following.select(*KEYS))
        plain, beside = self._by_heat(ordinary, touched)
        plain_prior, beside_prior = self._by_heat(prior, touched)
        met = statement.monthly_statement(plain, self.entity, self.run_ts, prior=plain_prior)
        salted = beside.withColumn(SALT, F.lit(0)).unionByName(hot)
        split = statement.monthly_statement(salted, self.entity, self.run_ts, self.hot, prior=beside_prior.unionByName(hot_prior))
        return self._current(met.unionByName(split))
