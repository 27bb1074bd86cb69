"""Micro-calcs: named one-column metrics, grouped by the table they are computed on.

A calc is a function returning a Column over its base table. A lookup calc reads one other table by
key as well; its expression sees that table's row as the struct ``lookup``. New metrics are added with
:func:`register`; every assembled table and widetable picks them up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.functions import numeric


@dataclass(frozen=True)
class Calc:
    group: str
    name: str
    expression: Callable[[], Column]
    lookup_table: str | None = None
    lookup_key: str | None = None


REGISTRY: dict[str, dict[str, Calc]] = {}


def register(calc: Calc) -> Calc:
    REGISTRY.setdefault(calc.group, {})[calc.name] = calc
    return calc


def base_table(group: str) -> str:
    """Name of the table a group is computed on: the group name without its ``Calc`` ending."""
    return group.removesuffix("Calc")


def calcs_of(group: str) -> list[Calc]:
    """The calcs of a group in name order."""
    return [calc for _, calc in sorted(REGISTRY.get(group, {}).items())]


def month(name: str) -> Callable[[], Column]:
    return lambda: F.trunc(name, "MM")


def quarter(name: str) -> Callable[[], Column]:
    return lambda: F.trunc(name, "QUARTER")


def year(name: str) -> Callable[[], Column]:
    return lambda: F.year(name).cast("bigint")


def code_is(name: str, code: str) -> Callable[[], Column]:
    return lambda: F.upper(name) == code


def days_between(start: Callable[[], Column], end: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.datediff(end(), start()).cast("bigint")


def rounded(name: str, places: int) -> Callable[[], Column]:
    return lambda: F.round(name, places)


def _asset_class() -> Column:
    asset = F.col("AssetId")
    return (
        F.when(asset.isin(*K.STABLECOINS), "Stablecoin")
        .when(asset.isin(*K.LAYER_ONE_ASSETS), "Layer1")
        .otherwise("AltCoin")
    )


def _valuation_tier() -> Column:
    value = F.col("ValuationUSD")
    return (
        F.when(value >= K.INSTITUTIONAL_MIN_USD, "Institutional")
        .when(value >= K.PRIME_MIN_USD, "Prime")
        .otherwise("Standard")
    )


def _days_in_month() -> Column:
    return F.day(F.last_day("PositionDate")).cast("bigint")


def _age_in_months() -> Column:
    # Month boundaries crossed, so 31 January to 1 February counts as one.
    created = F.to_date("CreatedAt")
    years = F.year("PositionDate") - F.year(created)
    return (years * 12 + F.month("PositionDate") - F.month(created)).cast("bigint")


def _effective_rate() -> Column:
    return numeric.divide(F.col("FeeAmountUSD"), F.col("AumAtBilling")) * F.lit(10000)


def _unbonding_category() -> Column:
    days = F.col("lookup.UnbondingDays")
    return (
        F.when(days == K.IMMEDIATE_DAYS, "Immediate")
        .when(days <= K.SHORT_TAIL_DAYS, "ShortTail")
        .when(days <= K.MEDIUM_TAIL_DAYS, "MediumTail")
        .otherwise("LongTail")
    )


def _event_date() -> Column:
    return F.to_date("EventTimestamp")


_POSITIONS = {
    "AssetClass": _asset_class,
    "DaysInPeriod": _days_in_month,
    "IsPeriodEnd": lambda: F.col("PositionDate") == F.last_day("PositionDate"),
    "IsStablecoin": lambda: F.col("AssetId").isin(*K.STABLECOINS),
    "PositionAgeMonths": _age_in_months,
    "PositionPeriod": month("PositionDate"),
    "PositionQuarter": quarter("PositionDate"),
    "PositionYear": year("PositionDate"),
    "ValuationTier": _valuation_tier,
    "ValuationUSDRounded": rounded("ValuationUSD", 2),
}
_FEES = {
    "EffectiveRateBps": _effective_rate,
    "FeeAmountUSDRounded": rounded("FeeAmountUSD", 2),
    "FeePeriod": month("FeePeriodStart"),
    "FeePeriodDays": days_between(lambda: F.col("FeePeriodStart"), lambda: F.col("FeePeriodEnd")),
    "FeeQuarter": quarter("FeePeriodStart"),
    "FeeYear": year("FeePeriodStart"),
    "IsAccruedNotBilled": code_is("BillingStatus", "ACCRUED"),
    "IsCustodyFee": code_is("FeeType", "CUSTODY"),
    "IsFullyBilled": code_is("BillingStatus", "BILLED"),
    "IsWaived": code_is("BillingStatus", "WAIVED"),
}
_FINANCIAL = {
    "EventPeriod": month("PeriodDate"),
    "EventQuarter": quarter("PeriodDate"),
    "EventYear": year("PeriodDate"),
    "IsCustodyEvent": code_is("ProductLine", "CUSTODY"),
    "IsPending": code_is("Status", "PENDING"),
    "IsSameDaySettle": lambda: _event_date() == F.col("SettlementDate"),
    "IsSettledFinancial": code_is("Status", "SETTLED"),
    "IsStakingEvent": code_is("ProductLine", "STAKING"),
    "NetAmountRoundedFinancial": rounded("NetAmount", 2),
    "SettlementLagDays": days_between(_event_date, lambda: F.col("SettlementDate")),
}
_STAKING = {
    "EarnPeriod": month("EarnDate"),
    "EarnQuarter": quarter("EarnDate"),
    "EarnYear": year("EarnDate"),
    "IsBelowMinDistribution": lambda: F.col("NetAmount") < F.lit(K.MIN_DISTRIBUTION),
    "IsDistributed": lambda: F.col("DistributeDate").isNotNull(),
    "IsSettledStaking": code_is("RewardState", "SETTLED"),
    "NetAmountRoundedStaking": rounded("NetAmount", 8),
    "SettlePeriod": month("SettleDate"),
    "UnbondingDays": days_between(lambda: F.col("EarnDate"), lambda: F.col("SettleDate")),
}

for _group, _calcs in {
    "CustodyPositionsCalc": _POSITIONS,
    "FeeEventsCalc": _FEES,
    "FinancialEventsCalc": _FINANCIAL,
    "StakingEventsCalc": _STAKING,
}.items():
    for _name, _expression in _calcs.items():
        register(Calc(_group, _name, _expression))
register(Calc("StakingEventsCalc", "UnbondingCategory", _unbonding_category, "ReferenceAssets", "AssetId"))
