"""Client-facing monthly statement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.functions import numeric
from closebook.operators.skew import FAN_AFTER, FAN_BEFORE, join_by_key
from closebook.operators.views import KEYS

STATEMENT_COLUMNS = (
    "StatementId", "CustomerId", "CustomerName", "CustomerType", "Jurisdiction", "RiskTier", "AssetId", "Symbol",
    "AssetName", "AssetType", "Protocol", "IsStakeable", "UnbondingDays", "PositionPeriod", "PeriodLabel",
    "PeriodEndDate", "PeriodEndQuantity", "PeriodEndPriceUSD", "PeriodEndValuationUSD", "CustodianLedgerRef",
    "QuantityChangePeriodOverPeriod", "ValuationChangePeriodOverPeriodUSD", "ValuationChangePctPeriodOverPeriod",
    "SettledNetRewards", "TotalNetRewardsAllStates", "NetPendingRewards", "PriorPeriodSettledNetRewards",
    "TotalPositionValueWithNetpenUSD", "TotalFeesUSD", "BilledFeesUSD", "AllFeesBilled", "StatementGeneratedAt",
    "IssuingEntity",
)


def approved_only(positions: DataFrame) -> DataFrame:
    return positions.filter(F.col("KycStatus") == K.APPROVED)


def prior_rows(positions: DataFrame, with_fan: bool = False) -> DataFrame:
    """What a statement shows of the month before, by the month that shows it, and the number of salts there.

    The number (``skew.FAN_AFTER`` of the positions) only if it is asked for.
    """
    fan = [FAN_AFTER] if with_fan else []
    return positions.select(
        "CustomerId",
        "AssetId",
        F.add_months("PositionPeriod", 1).alias("PositionPeriod"),
        F.col("PeriodEndQuantity").alias("PriorPeriodQuantity"),
        F.col("PeriodEndValuationUSD").alias("PriorPeriodValuationUSD"),
        F.col("SettledNetRewards").alias("PriorPeriodSettledNetRewards"),
        *fan,
    )


def with_prior_period(positions: DataFrame, hot: DataFrame | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Left join with the month before; several rows per key fan out.

    The prior side, :func:`prior_rows` of the same positions unless it is given, is shifted forward by a month, so the
    current side keeps its partitioning.
    """
    return join_by_key(positions, prior_rows(positions) if prior is None else prior, KEYS, hot)


PRIOR = "_prior"  # the rows of the month before, as a list


def with_prior_list(positions: DataFrame) -> DataFrame:
    """Every row with a list of the approved rows of the month before (:data:`PRIOR`), in one pass over rows of a client and asset."""
    month = F.year("PositionPeriod") * 12 + F.month("PositionPeriod")
    before = Window.partitionBy("CustomerId", "AssetId").orderBy("_month").rangeBetween(-1, -1)
    shown = F.struct(
        F.col("PeriodEndQuantity").alias("PriorPeriodQuantity"),
        F.col("PeriodEndValuationUSD").alias("PriorPeriodValuationUSD"),
        F.col("SettledNetRewards").alias("PriorPeriodSettledNetRewards"),
    )
    approved = F.when(F.col("KycStatus") == K.APPROVED, shown)  # a list leaves NULL out
    return positions.withColumn("_month", month).withColumn(PRIOR, F.collect_list(approved).over(before)).drop("_month")


def beside_prior_period(positions: DataFrame) -> DataFrame:
    """The same as :func:`with_prior_period` where no key has very many rows, in one pass and without a join.

    Rows are brought together by client and asset; every row collects the rows of the month before, unless it has them
    already (:func:`with_prior_list`), and is repeated for each of them. Rows that are known to follow a hot key
    (``skew.FAN_BEFORE``) are left out, for a salted join.
    """
    found = positions if PRIOR in positions.columns else with_prior_list(positions)
    if FAN_BEFORE in positions.columns:
        found = found.filter(F.col(FAN_BEFORE).isNull())
    columns = [name for name in positions.columns if name != PRIOR]
    return found.withColumn(PRIOR, F.explode_outer(PRIOR)).select(*columns, f"{PRIOR}.*")


def change(current: str, prior: str) -> Column:
    return numeric.subtract(F.col(current), F.coalesce(F.col(prior), F.lit(0)))


def change_pct(current: str, prior: str) -> Column:
    """Change in percent with four decimals; NULL where the prior value is missing or zero."""
    ratio = numeric.divide(numeric.subtract(F.col(current), F.col(prior)), F.col(prior))
    return F.round(ratio * F.lit(100), 4)


def if_stakeable(name: str) -> Column:
    return F.when(F.col("IsStakeable"), F.col(name)).alias(name)


def period_label(date: str) -> Column:
    return F.date_format(F.trunc(date, "MM"), "MMMM yyyy")


def statement_id() -> Column:
    parts = [F.col("CustomerId"), F.col("AssetId"), F.col("PositionPeriod").cast("string")]
    return F.md5(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2]))


def monthly_statement(
    positions: DataFrame,
    entity: str = K.DEFAULT_ENTITY,
    run_ts: Column | None = None,
    hot: DataFrame | None = None,
    prior: DataFrame | None = None,
    even: bool = False,
) -> DataFrame:
    """Statement rows of approved clients with changes against the prior month (unordered), see :func:`with_prior_period`.

    With ``even`` (no client and asset has very many rows) see :func:`beside_prior_period`.
    """
    reward_columns = (
        "SettledNetRewards", "TotalNetRewardsAllStates", "NetPendingRewards", "PriorPeriodSettledNetRewards",
    )
    computed = {
        "StatementId": statement_id(),
        "PeriodLabel": period_label("PeriodEndDate"),
        "QuantityChangePeriodOverPeriod": change("PeriodEndQuantity", "PriorPeriodQuantity"),
        "ValuationChangePeriodOverPeriodUSD": change("PeriodEndValuationUSD", "PriorPeriodValuationUSD"),
        "ValuationChangePctPeriodOverPeriod": change_pct("PeriodEndValuationUSD", "PriorPeriodValuationUSD"),
        "StatementGeneratedAt": F.current_timestamp() if run_ts is None else run_ts,
        "IssuingEntity": F.lit(entity),
        **{name: if_stakeable(name) for name in reward_columns},
    }
    approved = approved_only(positions)
    rows = beside_prior_period(approved) if even else with_prior_period(approved, hot, prior)
    return rows.select(*[computed.get(name, F.col(name)).alias(name) for name in STATEMENT_COLUMNS])


# Columns of a statement that follow from others of the same row.
DERIVED = {"StatementId": statement_id, "PeriodLabel": lambda: period_label("PeriodEndDate")}


def order_statement(rows: DataFrame, derived: Sequence[str] = ()) -> DataFrame:
    """Client name, month, asset symbol; further columns break ties, which also lets Spark split them over tasks.

    ``derived`` names columns (of :data:`DERIVED`) that hold what :func:`monthly_statement` gives them. They are made again
    after the rows are in order, so they need not travel.
    """
    made = {name: DERIVED[name]() for name in derived if name in rows.columns}
    by = ("CustomerName", "PositionPeriod", "Symbol", "StatementId", "CustodianLedgerRef", "PeriodEndQuantity", "QuantityChangePeriodOverPeriod")
    ordered = rows.drop(*made).orderBy(*[made.get(name, F.col(name)) for name in by])
    return ordered.select(*[made.get(name, F.col(name)).alias(name) for name in rows.columns]) if made else ordered
