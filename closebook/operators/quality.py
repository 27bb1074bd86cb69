"""Data-quality tests: each returns the violating rows, so no rows means pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fee_amounts_positive(fees: DataFrame) -> DataFrame:
    """Fees, rates or assets under management that are zero or negative."""
    reason = (
        F.when(F.col("FeeAmountUSD") <= 0, "ZERO_OR_NEGATIVE_FEE")
        .when(F.col("BasisPoints") <= 0, "INVALID_BASIS_POINTS")
        .when(F.col("AumAtBilling") <= 0, "ZERO_OR_NEGATIVE_AUM")
    )
    columns = (
        "ID", "CustomerId", "AssetId", "FeeType", "BasisPoints", "FeeAmountUSD", "AumAtBilling", "FeePeriodStart",
    )
    return fees.select(*columns, reason.alias("failure_reason")).filter("failure_reason IS NOT NULL")


def no_duplicate_events(events: DataFrame) -> DataFrame:
    """Event IDs occurring more than once."""
    counts = events.groupBy("ID").agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counts.filter("duplicate_count > 1").withColumn("failure_reason", F.lit("DUPLICATE_EVENT_ID"))


def no_negative_balances(positions: DataFrame) -> DataFrame:
    """Positions with a negative valuation, quantity or price."""
    negative = (F.col("ValuationUSD") < 0) | (F.col("Quantity") < 0) | (F.col("PriceUSD") < 0)
    columns = ("ID", "CustomerId", "AssetId", "Quantity", "PriceUSD", "ValuationUSD", "PositionDate")
    return positions.filter(negative).select(*columns, F.lit("NEGATIVE_BALANCE").alias("failure_reason"))


def settled_within_earned(rewards: DataFrame) -> DataFrame:
    """Reward groups with more settled than earned, or with negative pending rewards."""
    reason = F.when(
        F.col("SettledNetRewards") > F.col("TotalNetRewardsAllStates"), "SETTLED_EXCEEDS_EARNED"
    ).when(F.col("NetPendingRewards") < 0, "NEGATIVE_PENDING_REWARDS")
    columns = (
        "CustomerId", "AssetId", "RewardPeriod", "SettledNetRewards", "TotalNetRewardsAllStates", "NetPendingRewards",
    )
    return rewards.select(*columns, reason.alias("failure_reason")).filter("failure_reason IS NOT NULL")


def no_scientific_notation(df: DataFrame, column: str) -> DataFrame:
    """Values whose text form contains an exponent."""
    has_exponent = F.col(column).cast("string").ilike("%e%")
    return df.filter(has_exponent).select(column, F.lit("SCIENTIFIC_NOTATION_IN_AMOUNT").alias("failure_reason"))


def take_rate_in_bounds(
    rewards: DataFrame, column: str = "FeeTakeRatePct", min_pct: float = 5, max_pct: float = 15
) -> DataFrame:
    """Rates outside the closed interval; NULL rates pass."""
    outside = (F.col(column) < F.lit(min_pct)) | (F.col(column) > F.lit(max_pct))
    return rewards.filter(outside).select(
        "CustomerId",
        "AssetId",
        "RewardPeriod",
        F.col(column).alias("fee_take_rate_pct"),
        F.lit("FEE_RATE_OUT_OF_BOUNDS").alias("failure_reason"),
    )


def all_records_reconciled(
    summary: DataFrame, column: str = "ReconciliationStatus", clean: str = "RECONCILED"
) -> DataFrame:
    """Rows whose status is not the clean one; NULL passes."""
    return summary.filter(F.col(column) != clean).select(
        "CustomerId", "Symbol", "PositionPeriod", column, F.lit("NOT_RECONCILED_AT_PERIOD_CLOSE").alias("failure_reason")
    )
