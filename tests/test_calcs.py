from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from closebook.functions.calcs import REGISTRY, Calc, calcs_of, register
from closebook.operators.assembly import calc_table, join_calc_tables, micro_calc, wide_table
from tests.samples import asset, event, fee, position, reward, rows


def calc_row(spark, table, record, assets=()):
    lookups = {"ReferenceAssets": rows(spark, "ReferenceAssets", *assets)}
    return calc_table(rows(spark, table, record), f"{table}Calc", lookups).first()


def test_registry_holds_ten_calcs_per_group():
    assert {group: len(calcs) for group, calcs in REGISTRY.items()} == dict.fromkeys(
        ("CustodyPositionsCalc", "FeeEventsCalc", "FinancialEventsCalc", "StakingEventsCalc"), 10
    )


@pytest.mark.parametrize(
    ("asset_id", "expected", "stable"),
    [("ASSET_USDT", "Stablecoin", True), ("ASSET_SOL", "Layer1", False), ("ASSET_DOT", "AltCoin", False), (None, "AltCoin", None)],
)
def test_asset_class(spark, asset_id, expected, stable):
    row = calc_row(spark, "CustodyPositions", position("P", date(2025, 3, 1), AssetId=asset_id))
    assert (row.AssetClass, row.IsStablecoin) == (expected, stable)


def test_position_dates(spark):
    row = calc_row(spark, "CustodyPositions", position("P", date(2024, 2, 29), CreatedAt=datetime(2023, 12, 31, 23)))
    assert row.DaysInPeriod == 29 and row.IsPeriodEnd
    assert row.PositionPeriod == date(2024, 2, 1) and row.PositionQuarter == date(2024, 1, 1) and row.PositionYear == 2024
    assert row.PositionAgeMonths == 2


def test_age_counts_month_boundaries(spark):
    row = calc_row(spark, "CustodyPositions", position("P", date(2025, 2, 1), CreatedAt=datetime(2025, 1, 31, 22)))
    assert row.PositionAgeMonths == 1


@pytest.mark.parametrize(
    ("value", "tier"),
    [("10000000", "Institutional"), ("9999999.99", "Prime"), ("1000000", "Prime"), ("999999.99", "Standard"), (None, "Standard")],
)
def test_valuation_tier(spark, value, tier):
    record = position("P", date(2025, 3, 1))
    assert calc_row(spark, "CustodyPositions", {**record, "ValuationUSD": value}).ValuationTier == tier


def test_rounding_is_half_away_from_zero(spark):
    assert calc_row(spark, "CustodyPositions", position("P", date(2025, 3, 1), value="2.345")).ValuationUSDRounded == Decimal("2.35")
    assert calc_row(spark, "CustodyPositions", position("P", date(2025, 3, 1), value="-2.345")).ValuationUSDRounded == Decimal("-2.35")


def test_fee_calcs(spark):
    record = fee("F", date(2025, 5, 1), amount=1, status="Accrued", kind="CUSTODY", AumAtBilling=3, FeePeriodEnd=date(2025, 5, 31))
    row = calc_row(spark, "FeeEvents", record)
    assert row.EffectiveRateBps == Decimal("3333.33333")  # the quotient has nine decimals
    assert row.FeePeriodDays == 30 and row.FeeQuarter == date(2025, 4, 1) and row.FeeYear == 2025
    assert row.IsAccruedNotBilled and row.IsCustodyFee and not row.IsFullyBilled and not row.IsWaived


def test_rate_without_assets_is_null(spark):
    assert calc_row(spark, "FeeEvents", fee("F", date(2025, 5, 1), AumAtBilling=0)).EffectiveRateBps is None


def test_null_billing_status_stays_null(spark):
    row = calc_row(spark, "FeeEvents", fee("F", date(2025, 5, 1), status=None))
    assert row.IsFullyBilled is None and row.IsWaived is None


def test_financial_calcs(spark):
    row = calc_row(spark, "FinancialEvents", event("E", date(2025, 3, 31), status="PENDING", SettlementDate=date(2025, 3, 5)))
    assert row.EventPeriod == date(2025, 3, 1) and row.IsPending and not row.IsSettledFinancial
    assert row.IsSameDaySettle and row.SettlementLagDays == 0
    open_row = calc_row(spark, "FinancialEvents", event("E", date(2025, 3, 31), SettlementDate=None))
    assert open_row.IsSameDaySettle is None and open_row.SettlementLagDays is None


@pytest.mark.parametrize(
    ("days", "category"), [(0, "Immediate"), (1, "ShortTail"), (3, "ShortTail"), (21, "MediumTail"), (22, "LongTail"), (None, "LongTail")]
)
def test_unbonding_category(spark, days, category):
    record = reward("S", date(2025, 3, 1), 1)
    assert calc_row(spark, "StakingEvents", record, [asset("ETH", days=days)]).UnbondingCategory == category


def test_unknown_asset_is_null_in_the_table_and_absent_in_the_calc(spark):
    events = rows(spark, "StakingEvents", reward("S", date(2025, 3, 1), 1, asset="XRP"))
    lookups = {"ReferenceAssets": rows(spark, "ReferenceAssets", asset("ETH"))}
    assert calc_table(events, "StakingEventsCalc", lookups).first().UnbondingCategory is None
    assert micro_calc(events, REGISTRY["StakingEventsCalc"]["UnbondingCategory"], lookups).count() == 0


def test_staking_calcs(spark):
    record = reward("S", date(2025, 1, 31), "0.00009999", SettleDate=date(2025, 2, 3))
    row = calc_row(spark, "StakingEvents", record, [asset("ETH")])
    assert row.IsBelowMinDistribution and not row.IsDistributed and row.UnbondingDays == 3
    assert row.EarnPeriod == date(2025, 1, 1) and row.SettlePeriod == date(2025, 2, 1)
    assert row.NetAmountRoundedStaking == Decimal("0.00009999")


def test_fused_table_equals_one_join_per_calc(spark):
    base = rows(spark, "FeeEvents", *[fee(f"F{i}", date(2025, 1 + i % 12, 1), amount=i, status=["billed", "waived", None][i % 3]) for i in range(30)])
    parts = [micro_calc(base, calc) for calc in calcs_of("FeeEventsCalc")]
    joined = reduce(lambda left, right: left.join(right, "ID", "left"), parts, base.select("ID"))
    fused = calc_table(base, "FeeEventsCalc")
    assert fused.columns == joined.columns == ["ID", *sorted(fused.columns[1:])]
    assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)


def test_fused_calcs_do_not_shuffle(spark):
    plan = calc_table(rows(spark, "FeeEvents", fee("F", date(2025, 1, 1))), "FeeEventsCalc")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_widetable_has_two_structs_and_drops_null_ids(spark):
    base = rows(spark, "FeeEvents", fee("F", date(2025, 1, 1)), fee(None, date(2025, 1, 1)))
    wide = wide_table(base, "FeeEventsCalc")
    assert wide.columns == ["FeeEvents", "FeeEventsCalc"] and wide.count() == 1
    stored = join_calc_tables(base, calc_table(base, "FeeEventsCalc"), "FeeEventsCalc")
    assert stored.collect() == wide.collect()


def test_null_id_keeps_its_row_without_calcs(spark):
    table = calc_table(rows(spark, "FeeEvents", fee(None, date(2025, 1, 1))), "FeeEventsCalc")
    assert table.count() == 1 and set(table.first()) == {None}


def test_a_new_calc_appears_by_itself_and_an_empty_group_is_skipped(spark):
    base = rows(spark, "FeeEvents", fee("F", date(2025, 1, 1)))
    register(Calc("FeeEventsCalc", "ZeroFee", lambda: F.col("FeeAmountUSD") == 0))
    try:
        assert calc_table(base, "FeeEventsCalc").columns[-1] == "ZeroFee"
        assert "ZeroFee" in wide_table(base, "FeeEventsCalc").schema["FeeEventsCalc"].dataType.names
    finally:
        del REGISTRY["FeeEventsCalc"]["ZeroFee"]
    assert calc_table(base, "NothingCalc") is None
