from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closebook.operators import tieout, views
from tests.samples import asset, books, client, event, fee, position, reward

MARCH = date(2025, 3, 1)


def test_balances_keep_the_latest_date_with_ties(spark):
    result = books(
        spark,
        positions=[
            position("P1", date(2025, 3, 10)),
            position("P2", date(2025, 3, 28), ref="A"),
            position("P3", date(2025, 3, 28), ref="B"),
            position("P4", date(2025, 4, 2), ref="C"),
            position("P5", None),
            position("P6", date(2025, 3, 31), CustomerId=None),
        ],
    ).balances
    found = sorted((row.PositionPeriod, row.PeriodEndDate, row.CustodianLedgerRef) for row in result.collect())
    assert found == [
        (MARCH, date(2025, 3, 28), "A"),
        (MARCH, date(2025, 3, 28), "B"),
        (date(2025, 4, 1), date(2025, 4, 2), "C"),
    ]


def test_rewards_by_state(spark):
    row = books(
        spark,
        rewards=[
            reward("S1", date(2025, 3, 2), net=9, gross=10, fee=1),
            reward("S2", date(2025, 3, 9), net=18, gross=20, fee=2, state="pending"),
            reward("S3", date(2025, 3, 9), net=5, gross=5, fee=0, state=None),
        ],
    ).staking_rewards.first()
    assert row.RewardPeriod == MARCH and row.UnbondingCategory == "Immediate" and row.TotalRewardEvents == 3
    assert (row.SettledNetRewards, row.SettledGrossRewards, row.SettledFees) == (9, 10, 1)
    assert (row.NetPendingRewards, row.GrossPendingRewards) == (18, 20)  # a NULL state is in neither sum
    assert (row.TotalNetRewardsAllStates, row.TotalGrossRewardsAllStates, row.TotalFeesAllStates) == (32, 35, 3)
    assert row.FeeTakeRatePct == Decimal("0.085714286")


def test_take_rate_is_null_without_gross_rewards(spark):
    assert books(spark, rewards=[reward("S", MARCH, net=0)]).staking_rewards.first().FeeTakeRatePct is None


def test_fees_with_null_status(spark):
    row = books(
        spark,
        fees=[
            fee("F1", MARCH, 5, invoice="INV-2"),
            fee("F2", MARCH, 7, status="accrued"),
            fee("F3", MARCH, 11, status=None, invoice="INV-1"),
        ],
    ).fee_accruals.first()
    assert (row.TotalFeeAmountUSD, row.BilledFeeAmountUSD, row.PendingFeeAmountUSD) == (23, 5, 7)
    assert row.AllFeesBilled is False and row.FeeEventCount == 3 and row.AvgBasisPoints == 15.0
    assert row.InvoiceReferences == "INV-1, INV-2"


def test_fees_without_invoices_have_no_list(spark):
    b = books(spark, fees=[fee("F", MARCH, status=None)])
    row = b.fee_accruals.first()
    assert row.InvoiceReferences is None and row.AllFeesBilled is None


def test_fees_collapse_over_types(spark):
    b = books(spark, fees=[fee("F1", MARCH, 5, invoice="B"), fee("F2", MARCH, 7, invoice="A", kind="staking")])
    row = views.fees_collapsed(b.fee_accruals).first()
    assert row.TotalFeesUSD == 12 and row.AllFeesBilled and row.AllInvoiceReferences == "A | B"


def test_client_positions_add_pending_rewards(spark):
    row = books(
        spark,
        positions=[position("P", date(2025, 3, 28), quantity=2, price="10.5")],
        rewards=[reward("S", date(2025, 3, 9), net="0.00000001", state="pending")],
    ).client_positions.first()
    assert row.TotalPositionValueWithNetpenUSD == Decimal("21.000000105")
    assert row.CustomerName == "Client C1" and row.Symbol == "ETH" and row.TotalFeesUSD is None
    assert row.ReconFlagFeeWithoutBalance is False


def test_unknown_client_and_asset_stay_in_the_spine(spark):
    row = books(spark, positions=[position("P", MARCH, client="C9", asset="XRP")]).client_positions.first()
    assert row.CustomerName is None and row.Symbol is None


@pytest.mark.parametrize(
    ("more", "expected"),
    [
        ({"valued": False, "events": [event("E", MARCH)], "fees": [fee("F", MARCH)]}, "MissingPosition"),
        ({"valued": False, "fees": [fee("F", MARCH)]}, "FeeWithoutBalance"),
        ({"events": [event("E", MARCH, status="Pending")], "fees": [fee("F", MARCH)]}, "HasPendingEvents"),
        ({"fees": [fee("F", MARCH, status="accrued")]}, "UnbilledFees"),
        ({}, "UnbilledFees"),
        ({"fees": [fee("F", MARCH)], "events": [event("E", MARCH)]}, "Reconciled"),
    ],
)
def test_reconciliation_status(spark, more, expected):
    valued = more.pop("valued", True)
    held = position("P", date(2025, 3, 28))
    row = books(spark, positions=[held if valued else {**held, "ValuationUSD": None}], entity="Bank", **more).reconciliation.first()
    assert row.ReconciliationStatus == expected and row.Entity == "Bank"


def test_reconciliation_order(spark):
    b = books(
        spark,
        positions=[position("P1", MARCH, client="C1"), position("P2", MARCH, client="C2"), position("P3", MARCH, client="C3")],
        fees=[fee("F1", MARCH, client="C1"), fee("F3", MARCH, client="C3")],
        events=[event("E", MARCH, status="pending", client="C3")],
    )
    statuses = [row.ReconciliationStatus for row in views.order_reconciliation(b.reconciliation).collect()]
    assert statuses == ["HasPendingEvents", "UnbilledFees", "Reconciled"]


@pytest.mark.parametrize(
    ("value", "ref", "status", "detail"),
    [
        ("20.01", "R", "MATCHED", None),
        ("20.02", "R", "VARIANCE_DETECTED", "Qty × Price restatement differs from computed valuation by $0.02"),
        ("15", "R", "VARIANCE_DETECTED", "Qty × Price restatement differs from computed valuation by $5"),
        ("20", None, "UNCONFIRMED", "No custodian ledger reference — position not confirmed by custodian"),
        ("15", None, "UNCONFIRMED", "No custodian ledger reference — position not confirmed by custodian"),
    ],
)
def test_tie_out(spark, value, ref, status, detail):
    row = books(spark, positions=[position("P", MARCH, value=value, ref=ref)]).tie_out.first()
    assert (row.LedgerStatus, row.ExceptionDetail) == (status, detail)
    assert row.VarianceUSD == Decimal(value) - 20 and row.RestatedValuationUSD == 20


def test_tie_out_order(spark):
    b = books(
        spark,
        positions=[
            position("P1", MARCH, client="C1"),
            position("P2", MARCH, client="C2", ref=None),
            position("P3", MARCH, client="C3", value=1),
            position("P4", MARCH, client="C4", value=1),
        ],
    )
    found = [(row.LedgerStatus, row.CustomerId) for row in tieout.order_tie_out(b.tie_out).collect()]
    assert found == [("VARIANCE_DETECTED", "C3"), ("VARIANCE_DETECTED", "C4"), ("UNCONFIRMED", "C2"), ("MATCHED", "C1")]


def test_run_stamp_is_a_parameter(spark):
    from pyspark.sql import functions as F

    from closebook.plans.books import Books
    from tests.samples import tables

    stamp = F.lit("2025-04-02 06:00:00").cast("timestamp")
    b = Books(tables(spark, positions=[position("P", MARCH)], clients=[client("C1")], assets=[asset("ETH")]), run_ts=stamp)
    stamps = {str(df.first()[-1]) for df in (b.client_positions, b.reconciliation, b.tie_out)}
    assert stamps == {"2025-04-02 06:00:00"}


def test_invoice_lists_of_any_length_are_sorted(spark):
    """Texts of few references each, put together in order; keys with nulls have lists of their own."""
    many = [fee(f"F{k}", MARCH, invoice=f"I{k * 37 % 100:02}") for k in range(100)]
    more = [fee("x", MARCH, invoice="B", client=None), fee("y", MARCH, invoice="A", client=None), fee("z", MARCH, kind=None, invoice="Z"), fee("n", MARCH, client="C9")]
    b = books(spark, fees=[*many, *more])
    lines = views.invoice_lines(b.wide("FeeEvents"))
    assert lines.count() == 103
    for rows in (1, 3, 7, 1000):
        lists = views.invoice_lists(lines.repartition(8), chunk_rows=rows)
        found = {(r.CustomerId, r.FeeType): r.InvoiceReferences for r in lists.collect()}
        assert found == {("C1", "custody"): ", ".join(f"I{k:02}" for k in range(100)), (None, "custody"): "A, B", ("C1", None): "Z"}
    accruals = {(r.CustomerId, r.FeeType): r for r in b.fee_accruals.collect()}
    assert len(accruals) == 4 and accruals["C9", "custody"].InvoiceReferences is None
    assert accruals[None, "custody"].InvoiceReferences == "A, B" and accruals["C1", None].InvoiceReferences == "Z"


def test_invoice_lists_by_client_equal_those_of_ordered_lines(spark):
    lines = spark.range(60).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("C"), (F.col("id") % 3).cast("string"))).alias("CustomerId"),
        F.lit("A").alias("AssetId"), F.lit(MARCH).alias("FeePeriod"),
        F.when(F.col("id") % 5 != 0, F.lit("custody")).alias("FeeType"),
        F.concat(F.lit("I"), F.floor(F.col("id") / 2).cast("string")).alias("InvoiceReference"),
    )
    expected = sorted(map(str, views.invoice_lists(lines).collect()))
    assert len(expected) == 8
    for rows in (1, 4, 100):
        assert sorted(map(str, views.invoice_lists(lines, chunk_rows=rows, deal=("CustomerId",)).collect())) == expected


def test_events_without_an_identifier_are_not_counted(spark):
    """As count("ID") does, though only the presence of an identifier is dealt."""
    b = books(
        spark,
        rewards=[reward("S1", MARCH, net=1), reward("S2", MARCH, net=1)],
        fees=[fee("F1", MARCH), fee("F2", MARCH)],
        events=[event("E1", MARCH, status="pending"), event("E2", MARCH, status="pending")],
    )

    def known(table, first):
        fields = F.col(table).withField("ID", F.when(F.col(f"{table}.ID") == first, F.col(f"{table}.ID")))
        return b.wide(table).withColumn(table, fields)

    sums = views.staking_rewards(known("StakingEvents", "S1"), ("CustomerId",)).first()
    fees = views.fee_sums(known("FeeEvents", "F1"), ("CustomerId",)).first()
    totals = views.financial_event_totals(known("FinancialEvents", "E1"), ("CustomerId",)).first()
    assert (sums["TotalRewardEvents"], fees["FeeEventCount"], totals["RawEventCount"], totals["PendingEventCount"]) == (1, 1, 1, 1)
