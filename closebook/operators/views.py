"""Business views per client, asset and month."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.functions import numeric
from closebook.operators.skew import (
    FAN, FAN_AFTER, FAN_BEFORE, LATEST, SALT, among, broadcast_if_small, dealt, hot_keys, join_by_key, latest_per_key, latest_with_fan,
)

KEYS = ("CustomerId", "AssetId", "PositionPeriod")
INVOICES = "AllInvoiceReferences"  # long texts, which the spine does without until they are asked for


def unsalted(df: DataFrame) -> DataFrame:
    return df.drop(SALT, FAN, FAN_BEFORE, FAN_AFTER)


def _flatten(wide: DataFrame, table: str, fields: tuple[str, ...], calcs: tuple[str, ...]) -> DataFrame:
    return wide.select(
        *[F.col(f"{table}.{name}").alias(name) for name in fields],
        *[F.col(f"{table}Calc.{name}").alias(name) for name in calcs],
    )


def hot_position_keys(wide_positions: DataFrame, **limits: int) -> DataFrame:
    """Client/asset/month keys with very many position rows, see :mod:`closebook.operators.skew`."""
    rows = _flatten(wide_positions, "CustodyPositions", ("CustomerId", "AssetId", "PositionDate"), ("PositionPeriod",))
    return hot_keys(rows.dropna(), KEYS, order="PositionDate", **limits)


def custody_balances(
    wide_positions: DataFrame, hot: DataFrame | None = None, keep_salt: bool = False, even: bool = False, deal: Sequence[int | str] = ()
) -> DataFrame:
    """Positions on the latest snapshot date of each client, asset and month; ties are all kept.

    With ``even`` no key is hot, and the rows get no salt but may be dealt by some of the keys, see :func:`skew.dealt`.
    """
    if hot is None and not even:
        hot = hot_position_keys(wide_positions)
    latest = latest_per_key(_positions(wide_positions), KEYS, "PositionDate", None if even else hot, by=["ID"], deal=deal)
    balances = _as_balances(latest, *([] if even else [SALT]))
    return balances if keep_salt else unsalted(balances)


def _as_balances(latest: DataFrame, *more: str) -> DataFrame:
    return latest.select(
        *KEYS,
        F.col("PositionDate").alias("PeriodEndDate"),
        F.col("Quantity").alias("PeriodEndQuantity"),
        F.col("PriceUSD").alias("PeriodEndPriceUSD"),
        F.col("ValuationUSD").alias("PeriodEndValuationUSD"),
        "CustodianLedgerRef",
        *more,
    )


def _positions(wide_positions: DataFrame) -> DataFrame:
    fields = (
        "ID", "CustomerId", "AssetId", "PositionDate", "Quantity", "PriceUSD", "ValuationUSD", "CustodianLedgerRef",
    )
    return _flatten(wide_positions, "CustodyPositions", fields, ("PositionPeriod",))


def balances_with_fan(wide_positions: DataFrame, deal: Sequence[int | str], min_rows: int) -> DataFrame:
    """Balances with their salt, the number of salts of their key and of the same client and asset a month earlier and later.

    For tables whose rows of a client fit a task, see :func:`skew.latest_with_fan`; a number is NULL where the key is not hot.
    """
    latest = latest_with_fan(_positions(wide_positions), KEYS, "PositionDate", ["ID"], deal, min_rows)
    month = F.year("PositionPeriod") * 12 + F.month("PositionPeriod")
    near = Window.partitionBy("CustomerId", "AssetId").orderBy("_month")
    balances = _as_balances(latest, SALT, FAN).withColumn("_month", month)
    found = {FAN_BEFORE: F.max(FAN).over(near.rangeBetween(-1, -1)), FAN_AFTER: F.max(FAN).over(near.rangeBetween(1, 1))}
    return balances.withColumns(found).drop("_month")


def balance_keys(balances: DataFrame) -> DataFrame:
    """The keys of :func:`balances_with_fan` as :func:`skew.hot_keys` gives them; one salt where a key is not hot."""
    fan = F.coalesce(F.max(FAN), F.lit(1))
    return balances.groupBy(*KEYS).agg(fan.alias(FAN), F.max("PeriodEndDate").alias(LATEST))


def _sum_where(condition: Column, name: str) -> Column:
    return F.sum(F.when(condition, F.col(name)).otherwise(0))


def staking_rewards(wide_staking: DataFrame, deal: Sequence[int | str] = (), only: DataFrame | None = None) -> DataFrame:
    """Settled, pending and total rewards per client, asset, month and unbonding category.

    Like the other sums, of rows that may be dealt first (see :func:`skew.dealt`); else Spark adds up within a task first.
    With ``only``, of some hot keys alone (see :func:`skew.among`).
    """
    events = _flatten(
        wide_staking,
        "StakingEvents",
        ("CustomerId", "AssetId", "ID", "NetAmount", "GrossAmount", "FeeAmount"),
        ("EarnPeriod", "IsSettledStaking", "UnbondingCategory"),
    ).withColumnRenamed("EarnPeriod", "RewardPeriod")
    settled = F.col("IsSettledStaking")
    rows = among(dealt(_counted(events), deal), only, ("CustomerId", "AssetId", "RewardPeriod"))
    totals = rows.groupBy("CustomerId", "AssetId", "RewardPeriod", "UnbondingCategory").agg(
        _sum_where(settled, "NetAmount").alias("SettledNetRewards"),
        _sum_where(settled, "GrossAmount").alias("SettledGrossRewards"),
        _sum_where(settled, "FeeAmount").alias("SettledFees"),
        _sum_where(~settled, "NetAmount").alias("NetPendingRewards"),
        _sum_where(~settled, "GrossAmount").alias("GrossPendingRewards"),
        F.sum("NetAmount").alias("TotalNetRewardsAllStates"),
        F.sum("GrossAmount").alias("TotalGrossRewardsAllStates"),
        F.sum("FeeAmount").alias("TotalFeesAllStates"),
        _count_ids().alias("TotalRewardEvents"),
    )
    take_rate = numeric.divide(F.col("TotalFeesAllStates"), F.col("TotalGrossRewardsAllStates"))
    return totals.withColumn("FeeTakeRatePct", take_rate)


def _counted(events: DataFrame) -> DataFrame:
    """Events of which only the presence of an identifier goes on to be counted, not its text."""
    return events.withColumn("ID", F.col("ID").isNotNull())


def _count_ids(condition: Column | None = None) -> Column:
    """Over :func:`_counted` events, as ``count("ID")`` over the others."""
    known = F.col("ID") if condition is None else F.col("ID") & condition
    return F.count(F.when(known, 1))


def _sorted_list(name: str, separator: str) -> Column:
    """All non-NULL values as one text in ascending order; NULL when there are none."""
    return F.expr(f"listagg({name}, '{separator}') WITHIN GROUP (ORDER BY {name})")


FEE_KEYS = ("CustomerId", "AssetId", "FeePeriod", "FeeType")
INVOICE_ROWS = 10_000  # invoice references of one key that a task puts into a text at once


def _fee_events(wide_fees: DataFrame) -> DataFrame:
    fields = ("CustomerId", "AssetId", "ID", "FeeType", "FeeAmountUSD", "AumAtBilling", "BasisPoints", "InvoiceReference")
    return _flatten(wide_fees, "FeeEvents", fields, ("FeePeriod", "IsFullyBilled"))


def fee_sums(wide_fees: DataFrame, deal: Sequence[int | str] = (), only: DataFrame | None = None) -> DataFrame:
    """Fees per client, asset, month and fee type, without the invoices."""
    billed = F.col("IsFullyBilled")
    events = _counted(_fee_events(wide_fees).drop("InvoiceReference"))
    return among(dealt(events, deal), only, FEE_KEYS[:3]).groupBy(*FEE_KEYS).agg(
        F.sum("FeeAmountUSD").alias("TotalFeeAmountUSD"),
        F.sum("AumAtBilling").alias("TotalAumBilled"),
        F.avg("BasisPoints").alias("AvgBasisPoints"),
        _count_ids().alias("FeeEventCount"),
        _sum_where(billed, "FeeAmountUSD").alias("BilledFeeAmountUSD"),
        _sum_where(~billed, "FeeAmountUSD").alias("PendingFeeAmountUSD"),
        F.bool_and(billed).alias("AllFeesBilled"),
    )


def invoice_lines(wide_fees: DataFrame) -> DataFrame:
    """One row per invoiced fee event: its key, the reference and the amount."""
    lines = _fee_events(wide_fees).filter("InvoiceReference IS NOT NULL")
    return lines.select(*FEE_KEYS, "InvoiceReference", "FeeAmountUSD")


def invoice_lists(
    lines: DataFrame, chunk_rows: int = INVOICE_ROWS, deal: Sequence[int | str] = (), only: DataFrame | None = None
) -> DataFrame:
    """The sorted references of every fee key as one text.

    Where all lines of a client fit a task they may be dealt by some of the keys, see :func:`skew.dealt`, and are
    numbered there, with ``only`` those of some hot keys alone.

    Else lines are ordered over all tasks by key and reference, so the references of a key with very many of
    them lie in several. Texts are made of at most ``chunk_rows`` neighbours first; a key's few texts
    are then put together in order, which is the only place where one task holds all of them.
    """
    references = lines.select(*FEE_KEYS, "InvoiceReference")
    if deal:
        in_order = Window.partitionBy(*FEE_KEYS).orderBy("InvoiceReference")
        chosen = among(dealt(references, deal), only, FEE_KEYS[:3])
        numbered = chosen.withColumn("_place", F.row_number().over(in_order) - 1)
        block = F.floor(F.col("_place") / chunk_rows)
    else:
        place = F.monotonically_increasing_id()  # the task, then the row in it
        ordered = references.repartitionByRange(*FEE_KEYS, "InvoiceReference")
        numbered = ordered.sortWithinPartitions(*FEE_KEYS, "InvoiceReference").withColumn("_place", place)
        block = F.shiftright("_place", 33) * F.lit(1 << 33) + F.floor(F.col("_place").bitwiseAND((1 << 33) - 1) / chunk_rows)
    texts = numbered.groupBy(*FEE_KEYS, block.alias("_block")).agg(_sorted_list("InvoiceReference", ", ").alias("_text"))
    joined = F.expr("listagg(_text, ', ') WITHIN GROUP (ORDER BY _block)")
    return texts.groupBy(*FEE_KEYS).agg(joined.alias("InvoiceReferences"))


def fee_accruals(wide_fees: DataFrame) -> DataFrame:
    """Fees per client, asset, month and fee type with their invoices."""
    lists = invoice_lists(invoice_lines(wide_fees)).withColumnsRenamed({name: f"_{name}" for name in FEE_KEYS})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in FEE_KEYS])
    return fee_sums(wide_fees).join(lists, same, "left").drop(*[f"_{name}" for name in FEE_KEYS])


def fees_collapsed(accruals: DataFrame) -> DataFrame:
    """Fee accruals (or sums) without the fee type, one row per client, asset and month."""
    lists = [_sorted_list("InvoiceReferences", " | ").alias(INVOICES)] if "InvoiceReferences" in accruals.columns else []
    return accruals.groupBy("CustomerId", "AssetId", "FeePeriod").agg(
        F.sum("TotalFeeAmountUSD").alias("TotalFeesUSD"),
        F.sum("BilledFeeAmountUSD").alias("BilledFeesUSD"),
        F.sum("PendingFeeAmountUSD").alias("PendingFeesUSD"),
        F.bool_and("AllFeesBilled").alias("AllFeesBilled"),
        *lists,
    )


def with_invoices(df: DataFrame, lists: DataFrame, hot: DataFrame | None = None, deal: Sequence[int | str] = (), only_hot: bool = False) -> DataFrame:
    """A spine or reconciliation with the invoices of its keys (``lists`` as :func:`invoice_lists` gives them)."""
    collapsed = dealt(lists, deal).groupBy("CustomerId", "AssetId", F.col("FeePeriod").alias("PositionPeriod")).agg(
        _sorted_list("InvoiceReferences", " | ").alias(INVOICES)
    )
    joined = join_by_key(df if only_hot else dealt(df, deal), collapsed, KEYS, hot, only_hot)
    place = df.columns.index("AllFeesBilled") + 1
    return joined.select(*df.columns[:place], INVOICES, *df.columns[place:])


def position_value_with_pending() -> Column:
    """Liquid valuation plus pending rewards at the period-end price."""
    pending = F.coalesce("NetPendingRewards", F.lit(0))
    return numeric.add(F.col("PeriodEndValuationUSD"), numeric.multiply(pending, F.col("PeriodEndPriceUSD")))


def fee_without_balance() -> Column:
    return F.coalesce(
        F.col("TotalFeesUSD").isNotNull() & F.col("PeriodEndValuationUSD").isNull(), F.lit(False)
    )


def client_positions(
    balances: DataFrame,
    customers: DataFrame,
    assets: DataFrame,
    rewards: DataFrame,
    accruals: DataFrame,
    run_ts: Column | None = None,
    hot: DataFrame | None = None,
    keep_salt: bool = False,
    only_hot: bool = False,
) -> DataFrame:
    """The reporting spine: balances with client, asset, reward and fee attributes, and invoices if ``accruals`` has them.

    The two fact joins come first: they use the partitioning that the balances already have.
    """
    reward_columns = {
        "SettledNetRewards": "SettledNetRewards",
        "SettledGrossRewards": "SettledGrossRewards",
        "SettledFees": "StakingFeesSettled",
        "NetPendingRewards": "NetPendingRewards",
        "GrossPendingRewards": "GrossPendingRewards",
        "TotalNetRewardsAllStates": "TotalNetRewardsAllStates",
        "TotalGrossRewardsAllStates": "TotalGrossRewardsAllStates",
        "TotalFeesAllStates": "TotalStakingFees",
        "TotalRewardEvents": "TotalRewardEvents",
        "FeeTakeRatePct": "StakingFeeTakeRatePct",
        "UnbondingCategory": "UnbondingCategory",
    }
    reward_rows = rewards.select(
        "CustomerId", "AssetId", F.col("RewardPeriod").alias("PositionPeriod"),
        *[F.col(old).alias(new) for old, new in reward_columns.items()],
    )
    fee_rows = fees_collapsed(accruals).withColumnRenamed("FeePeriod", "PositionPeriod")
    spine = join_by_key(balances, reward_rows, KEYS, hot, only_hot)
    spine = join_by_key(spine, fee_rows, KEYS, hot, only_hot)

    client_columns = ["CustomerName", "CustomerType", "Jurisdiction", "RiskTier", "KycStatus"]
    asset_columns = ["Symbol", "AssetName", "AssetType", "Protocol", "IsStakeable", "UnbondingDays"]
    spine = spine.join(broadcast_if_small(customers.select("CustomerId", *client_columns)), "CustomerId", "left")
    spine = spine.join(broadcast_if_small(assets.select("AssetId", *asset_columns)), "AssetId", "left")

    result = spine.select(
        *KEYS, *client_columns, *asset_columns,
        "PeriodEndDate", "PeriodEndQuantity", "PeriodEndPriceUSD", "PeriodEndValuationUSD", "CustodianLedgerRef",
        *reward_columns.values(),
        "TotalFeesUSD", "BilledFeesUSD", "PendingFeesUSD", "AllFeesBilled", *[c for c in (INVOICES,) if c in spine.columns],
        position_value_with_pending().alias("TotalPositionValueWithNetpenUSD"),
        fee_without_balance().alias("ReconFlagFeeWithoutBalance"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("_BuiltAt"),
        *[name for name in (SALT, FAN, FAN_BEFORE, FAN_AFTER) if name in spine.columns],
    )
    return result if keep_salt else unsalted(result)


def financial_event_totals(wide_financial: DataFrame, deal: Sequence[int | str] = ()) -> DataFrame:
    """Event counts and sums per client, asset and month."""
    events = _flatten(
        wide_financial,
        "FinancialEvents",
        ("CustomerId", "AssetId", "ID", "GrossAmount", "NetAmount"),
        ("EventPeriod", "IsPending"),
    )
    return dealt(_counted(events), deal).groupBy("CustomerId", "AssetId", "EventPeriod").agg(
        _count_ids().alias("RawEventCount"),
        F.sum("GrossAmount").alias("SumGrossFromEvents"),
        F.sum("NetAmount").alias("SumNetFromEvents"),
        _count_ids(F.col("IsPending")).alias("PendingEventCount"),
    )


def _reconciliation_status() -> Column:
    missing, fee_only, pending, unbilled, clean = K.RECONCILIATION_STATUSES
    no_value = F.col("PeriodEndValuationUSD").isNull()
    return (
        F.when(no_value & (F.col("RawEventCount") > 0), missing)
        .when(F.col("ReconFlagFeeWithoutBalance"), fee_only)
        .when(F.coalesce("PendingEventCount", F.lit(0)) > 0, pending)
        .when(~F.coalesce("AllFeesBilled", F.lit(False)), unbilled)
        .otherwise(clean)
    )


def reconciliation_summary(
    positions: DataFrame,
    event_totals: DataFrame,
    entity: str = K.DEFAULT_ENTITY,
    run_ts: Column | None = None,
    hot: DataFrame | None = None,
    keep_salt: bool = False,
    only_hot: bool = False,
) -> DataFrame:
    """Reconciliation status of every spine row against the event log (unordered)."""
    totals = event_totals.withColumnRenamed("EventPeriod", "PositionPeriod")
    rows = join_by_key(positions, totals, KEYS, hot, only_hot)
    lists = [name for name in (INVOICES,) if name in positions.columns]
    salt = [SALT] if keep_salt and SALT in rows.columns else []
    return rows.select(
        "CustomerId", "CustomerName", "AssetId", "Symbol", "PositionPeriod", "RiskTier",
        F.col("PeriodEndValuationUSD").alias("ReportedPositionUSD"),
        F.col("CustodianLedgerRef").alias("CustodianSourceRef"),
        F.col("TotalGrossRewardsAllStates").alias("ReportedGrossRewards"),
        F.col("TotalStakingFees").alias("ReportedStakingFees"),
        F.col("TotalNetRewardsAllStates").alias("ReportedNetRewards"),
        "NetPendingRewards",
        F.col("TotalFeesUSD").alias("ReportedFeesChargedUSD"),
        "BilledFeesUSD", "AllFeesBilled", *lists,
        "RawEventCount", "SumGrossFromEvents", "SumNetFromEvents", "PendingEventCount",
        F.lit(entity).alias("Entity"),
        _reconciliation_status().alias("ReconciliationStatus"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("ReconciliationRunAt"),
        *salt,
    )


def rank_in(column: str, values: tuple[str, ...]) -> Column:
    """Position of a value in a fixed order, everything else last."""
    rank = F.lit(len(values) + 1)
    for position, value in reversed(list(enumerate(values, start=1))):
        rank = F.when(F.col(column) == value, position).otherwise(rank)
    return rank


def order_reconciliation(summary: DataFrame) -> DataFrame:
    """Worst status first, then client and month; further columns only break ties."""
    return summary.orderBy(
        rank_in("ReconciliationStatus", K.RECONCILIATION_STATUSES),
        "CustomerId", "PositionPeriod", "AssetId", "CustodianSourceRef", "ReportedPositionUSD",
    )
