from datetime import date
from decimal import Decimal
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from closebook.operators import reports, statement
from closebook.operators.statement import STATEMENT_COLUMNS
from closebook.plans.books import Books
from closebook.session import materialise
from tests.samples import asset, books, client, position, reward, rows, tables

FEB, MARCH, MAY = date(2025, 2, 28), date(2025, 3, 31), date(2025, 5, 31)


def by_period(b):
    return {row.PeriodLabel: row for row in b.monthly_statement.collect()}


def test_changes_against_the_prior_month(spark):
    b = books(
        spark,
        positions=[position("P1", FEB, quantity=3), position("P2", MARCH, quantity=4), position("P3", MAY, quantity=1)],
        rewards=[reward("S", date(2025, 2, 5), net=7)],
    )
    assert b.monthly_statement.columns == list(STATEMENT_COLUMNS) and len(STATEMENT_COLUMNS) == 33
    found = by_period(b)
    march, may = found["March 2025"], found["May 2025"]
    assert march.QuantityChangePeriodOverPeriod == 1 and march.ValuationChangePeriodOverPeriodUSD == 10
    assert march.ValuationChangePctPeriodOverPeriod == Decimal("33.3333") and march.PriorPeriodSettledNetRewards == 7
    # April is missing, so May has no prior month.
    assert may.QuantityChangePeriodOverPeriod == 1 and may.ValuationChangePctPeriodOverPeriod is None
    assert march.StatementId == md5(b"C1|ASSET_ETH|2025-03-01").hexdigest()


def test_no_percentage_from_a_zero_prior_value(spark):
    b = books(spark, positions=[position("P1", FEB, value=0), position("P2", MARCH, quantity=4)])
    march = by_period(b)["March 2025"]
    assert march.ValuationChangePctPeriodOverPeriod is None and march.ValuationChangePeriodOverPeriodUSD == 40


def test_only_approved_clients(spark):
    held = [position(f"P{i}", MARCH, client=f"C{i}") for i in range(3)]
    b = books(spark, positions=held, clients=[client("C0"), client("C1", kyc="approved"), client("C2", kyc=None)])
    assert [row.CustomerId for row in b.monthly_statement.collect()] == ["C0"]


def test_rewards_only_on_stakeable_assets(spark):
    b = books(
        spark,
        positions=[position("P1", MARCH), position("P2", MARCH, asset="BTC")],
        rewards=[reward("S1", MARCH, net=1), reward("S2", MARCH, net=1, asset="BTC")],
    )
    settled = {row.Symbol: (row.SettledNetRewards, row.TotalNetRewardsAllStates, row.NetPendingRewards) for row in b.monthly_statement.collect()}
    assert settled == {"ETH": (1, 1, 0), "BTC": (None, None, None)}


def test_order(spark):
    b = books(
        spark,
        positions=[position("P1", MARCH), position("P2", FEB), position("P3", FEB, asset="BTC"), position("P4", MAY, client="B")],
        clients=[client("C1"), client("B")],
    )
    found = [(row.CustomerName, row.PositionPeriod.month, row.Symbol) for row in statement.order_statement(b.monthly_statement).collect()]
    assert found == [("Client B", 5, "ETH"), ("Client C1", 2, "BTC"), ("Client C1", 2, "ETH"), ("Client C1", 3, "ETH")]


def test_custody_report(spark):
    b = books(
        spark,
        positions=[position(f"P{i}", MARCH, client=f"C{i}") for i in range(4)],
        clients=[
            client("C0", CustomerType="HEDGE_FUND"),
            client("C1", CustomerType="FAMILY_OFFICE"),
            client("C2", CustomerType="HEDGE_FUND", active=False),
            client("C3", CustomerType="HEDGE_FUND", kyc="PENDING"),
        ],
    )
    report = b.report(reports.CUSTODY_MONTHLY)
    assert [row.CustomerName for row in report.collect()] == ["Client C0"]
    assert report.columns == [c["name"] for c in reports.CUSTODY_MONTHLY["columns"]]
    comments = {field.name: field.metadata["comment"] for field in report.schema}
    assert comments["PeriodEndQuantity"] == "Quantity Held"
    assert comments["StatementId"] == "Statement ID. Unique ID for this statement row — used as delivery idempotency key"
    source = {"source_model": "ClientPeriodPositions", "columns": [{"name": "KycStatus"}, {"name": "PendingFeesUSD"}]}
    assert b.report(source).columns == ["KycStatus", "PendingFeesUSD"]
    with pytest.raises(ValueError, match="unknown source model"):
        b.report({"source_model": "Elsewhere", "columns": []})


@pytest.mark.parametrize(
    ("rule", "kept"),
    [
        ({"operator": "equals", "value": "tier_1"}, ["A"]),
        ({"operator": "not_equals", "value": "tier_1"}, ["B"]),
        ({"operator": "in", "values": ["tier_2", "tier_3"]}, ["B"]),
    ],
)
def test_filters(spark, rule, kept):
    customers = rows(spark, "Customers", client("A", RiskTier="tier_1"), client("B", RiskTier="tier_2"), client("N"))
    found = reports.filter_clients(customers, [{"field": "RiskTier", **rule}])
    assert [row.CustomerId for row in found.collect()] == kept


def test_filters_combine_and_unknown_operators_raise(spark):
    customers = rows(spark, "Customers", client("A"), client("B", active=False))
    rules = [{"field": "IsActive", "operator": "equals", "value": True}, {"field": "CustomerId", "operator": "not_equals", "value": "A"}]
    assert reports.filter_clients(customers, rules).count() == 0
    assert reports.filter_clients(customers, []).count() == 2
    with pytest.raises(ValueError, match="like"):
        reports.filter_clients(customers, [{"field": "CustomerId", "operator": "like", "value": "A"}])


def test_projection_order_and_condition(spark):
    assets = rows(spark, "ReferenceAssets", asset("ETH"), asset("BTC", False))
    columns = [{"name": "Symbol"}, {"name": "AssetName", "order": 2, "include_if": "IsStakeable = false"}, {"name": "AssetId", "order": 1}]
    result = reports.project(assets, columns)
    assert result.columns == ["AssetId", "AssetName", "Symbol"]
    # The right-hand side of include_if is ignored.
    assert {row.Symbol: row.AssetName for row in result.collect()} == {"ETH": "Eth", "BTC": None}


def test_report_files(spark, tmp_path):
    pytest.importorskip("yaml")
    for name, status in (("b", "active"), ("a", "active"), ("c", "draft")):
        (tmp_path / f"{name}.yml").write_text(f"report_id: {name}\nstatus: {status}\ncolumns:\n  - name: Symbol\n")
    assert [c["report_id"] for c in reports.load_reports(str(tmp_path))] == ["a", "b"]
    assert [c["report_id"] for c in reports.load_reports(str(tmp_path), "b")] == ["b"]
    source = spark.range(1).select(*[F.lit("x").alias(name) for name in reports.SORT_COLUMNS])
    assert reports.report(reports.load_reports(str(tmp_path), "a")[0], source).columns == ["Symbol"]


def test_the_month_before_is_found_in_one_pass(spark):
    days = [FEB, FEB, MARCH, MARCH, MAY, date(2024, 12, 31), date(2025, 1, 31)]
    positions = [position(f"P{i}", day, quantity=i + 1, client=c) for c in ("C1", "C2") for i, day in enumerate(days)]
    spine = books(spark, positions=positions, clients=[client("C1"), client("C2")], rewards=[reward("S", date(2025, 2, 5), net=7)]).client_positions
    columns = ["CustomerId", "AssetId", "PositionPeriod", "PeriodEndQuantity", "PriorPeriodQuantity", "PriorPeriodValuationUSD", "PriorPeriodSettledNetRewards"]
    joined, beside = (
        sorted(map(str, df.select(*columns).collect())) for df in (statement.with_prior_period(spine), statement.beside_prior_period(spine))
    )
    assert beside == joined and len(joined) == 2 * (1 + 1 + 2 + 4 + 1)


def test_a_stored_spine_holds_the_month_before(spark):
    held = [position(f"P{m}{c}{k}", date(2025, m, 20), quantity=m + k, client=c, ref=f"R{k}") for m in (1, 2, 3, 5) for c in ("C1", "C2") for k in range(2)]
    # A client that is listed twice, once approved: only approved rows are a month before.
    clients = [client("C1"), client("C1", kyc="PENDING"), client("C2")]
    given = tables(spark, positions=held, clients=clients, rewards=[reward("S", date(2025, 2, 5), net=7)])
    stamp = F.lit("2025-04-02 06:00:00").cast("timestamp")
    stored = Books(given, run_ts=stamp, keep=materialise, prior_lists=True)
    assert stored.even and stored.client_positions.columns == Books(given).client_positions.columns
    expected = sorted(map(str, Books(given, run_ts=stamp).monthly_statement.collect()))
    assert sorted(map(str, stored.monthly_statement.collect())) == expected and len(expected) == 24
    plan = stored.monthly_statement._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_columns_that_follow_from_others_do_not_travel(spark):
    held = [position(f"P{m}{c}{k}", date(2025, m, 20), quantity=k, client=c) for m in (2, 3) for c in ("C1", "C2") for k in range(3)]
    same_name = [client("C1", CustomerName="x"), client("C2", CustomerName="x")]
    made = books(spark, positions=held, clients=same_name).monthly_statement.drop("StatementGeneratedAt")
    ordered = statement.order_statement(made, statement.DERIVED)
    assert ordered.columns == made.columns and ordered.collect() == statement.order_statement(made).collect()
    below = ordered._jdf.queryExecution().optimizedPlan().toString().split("Sort [")[1]
    assert not any(f"AS {name}" in below for name in ("StatementId", "PeriodLabel", "IssuingEntity"))
