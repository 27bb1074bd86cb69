from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from closebook.operators import contracts, quality
from closebook.schemas import SCHEMAS
from closebook.sources.tables import LOADED_AT, with_load_time
from tests.samples import asset, books, client, event, fee, position, reward, rows, tables

MARCH = date(2025, 3, 1)


def reasons(df):
    return {row[0]: row.failure_reason for row in df.collect()}


def test_fee_amounts(spark):
    fees = rows(
        spark, "FeeEvents", fee("ok", MARCH), fee("zero", MARCH, amount=0, BasisPoints=0), fee("rate", MARCH, BasisPoints=-1),
        fee("aum", MARCH, AumAtBilling=0), fee("null", MARCH, AumAtBilling=None),
    )
    assert reasons(quality.fee_amounts_positive(fees)) == {
        "zero": "ZERO_OR_NEGATIVE_FEE", "rate": "INVALID_BASIS_POINTS", "aum": "ZERO_OR_NEGATIVE_AUM",
    }


def test_duplicate_events(spark):
    events = rows(spark, "FinancialEvents", event("A", MARCH), event("A", MARCH), event("B", MARCH))
    assert [tuple(row) for row in quality.no_duplicate_events(events).collect()] == [("A", 2, "DUPLICATE_EVENT_ID")]


def test_negative_balances(spark):
    held = rows(spark, "CustodyPositions", position("ok", MARCH), position("q", MARCH, quantity=-1, value=1), position("v", MARCH, value=-1))
    assert set(reasons(quality.no_negative_balances(held))) == {"q", "v"}


def test_settled_within_earned(spark):
    b = books(
        spark,
        rewards=[
            reward("1", MARCH, net=5), reward("2", MARCH, net=-1, state="pending"),
            reward("3", MARCH, net=5, state=None, client="C2"), reward("4", MARCH, net=-9, state=None, client="C2"),
            reward("5", MARCH, net=1, client="C3"),
        ],
    )
    found = {row.CustomerId: row.failure_reason for row in quality.settled_within_earned(b.staking_rewards).collect()}
    assert found == {"C1": "SETTLED_EXCEEDS_EARNED", "C2": "SETTLED_EXCEEDS_EARNED"}


def test_scientific_notation(spark):
    df = spark.createDataFrame([(1.5,), (1.5e-8,), (3e20,), (None,)], "x double")
    assert [row.x for row in quality.no_scientific_notation(df, "x").collect()] == [1.5e-8, 3e20]
    exact = spark.createDataFrame([(Decimal("0.000000001"),)], "x decimal(38,9)")
    assert quality.no_scientific_notation(exact, "x").count() == 0


def test_take_rate(spark):
    rates = spark.createDataFrame([("a", 5.0), ("b", 4.9), ("c", 15.0), ("d", 15.1), ("e", None)], "CustomerId string, r double")
    rates = rates.withColumns({"AssetId": F.lit("A"), "RewardPeriod": F.lit(MARCH)})
    assert [row.CustomerId for row in quality.take_rate_in_bounds(rates, "r").collect()] == ["b", "d"]


def test_all_reconciled(spark):
    b = books(spark, positions=[position("P", MARCH)])
    assert quality.all_records_reconciled(b.reconciliation, clean="UnbilledFees").count() == 0
    assert quality.all_records_reconciled(b.reconciliation).first().failure_reason == "NOT_RECONCILED_AT_PERIOD_CLOSE"


def test_row_contracts(spark):
    held = rows(
        spark, "CustodyPositions", position("ok", MARCH), position("cent", MARCH, value="20.01"), position("off", MARCH, value="20.02"),
        position("asset", MARCH, asset="XRP"), position("noasset", MARCH, AssetId=None),
    )
    known = rows(spark, "ReferenceAssets", asset("ETH"))
    assert [row.ID for row in contracts.valuation_consistent(held).collect()] == ["off"]
    assert [row.ID for row in contracts.relationship(held, "AssetId", known, "AssetId").collect()] == ["asset"]
    assert [row.ID for row in contracts.not_null(held, "AssetId").collect()] == ["noasset"]
    assert contracts.at_least(held, "Quantity", 3).count() == 5 and contracts.at_least(held, "Quantity").count() == 0
    assert contracts.accepted_values(held, "AssetId", ["ASSET_ETH"]).count() == 1  # NULL is not an unknown value


def test_reward_and_invoice_contracts(spark):
    rewards = rows(spark, "StakingEvents", reward("ok", MARCH, net="9.0001", gross=10, fee=1), reward("off", MARCH, net="9.0002", gross=10, fee=1))
    assert [row.ID for row in contracts.net_reward_consistent(rewards).collect()] == ["off"]
    fees = rows(spark, "FeeEvents", fee("a", MARCH, status="invoiced"), fee("b", MARCH, status="invoiced", invoice="I"), fee("c", MARCH))
    assert [row.ID for row in contracts.invoice_reference_present(fees).collect()] == ["a"]


def test_keys(spark):
    held = rows(spark, "CustodyPositions", position("A", MARCH), position("A", MARCH, asset="BTC"), position(None, MARCH, asset="SOL"), position(None, MARCH, asset="DOT"))
    assert [tuple(row) for row in contracts.unique(held, "ID").collect()] == [("A", 2)]
    assert contracts.unique(held, ("CustomerId", "AssetId", "PositionDate")).count() == 0


def test_period_end_reference_counts_the_last_snapshot_only(spark):
    b = books(spark, positions=[position("early", MARCH, ref=None), position("end", date(2025, 3, 31)), position("apr", date(2025, 4, 3), ref=None)])
    found = contracts.period_end_reference_present(b.balances)
    assert [row.PositionPeriod for row in found.collect()] == [date(2025, 4, 1)]


def test_freshness(spark):
    held = rows(spark, "CustodyPositions", position("P", MARCH, CreatedAt=datetime(2025, 4, 1, 0, 0)))
    for hours, status in ((12, "pass"), (13, "warn"), (24, "warn"), (25, "error")):
        now = F.lit(datetime(2025, 4, 1 + hours // 24, hours % 24)).cast("timestamp")
        row = contracts.freshness(held, "CreatedAt", now, 12, 24).first()
        assert (row.AgeHours, row.Status) == (hours, status)
    assert contracts.contract_freshness(held, "CustodyPositions", "CreatedAt", now).first().Status == "error"
    assert contracts.freshness(held.limit(0), "CreatedAt", now, 12, 24).first().Status == "error"


def test_append_only(spark):
    before = rows(spark, "FinancialEvents", event("kept", MARCH), event("edited", MARCH), event("gone", MARCH))
    after = rows(spark, "FinancialEvents", event("kept", MARCH), event("edited", MARCH, GrossAmount=99), event("new", MARCH))
    assert sorted(row.ID for row in contracts.append_only(before, after).collect()) == ["edited", "gone"]
    moved = before.withColumns({"Status": F.lit(None).cast("string"), "ProductLine": F.col("Status")})
    swapped = before.withColumns({"Status": F.col("Status"), "ProductLine": F.lit(None).cast("string")})
    assert contracts.append_only(moved, swapped).count() == 3  # a NULL that changes place is a change


def test_snapshot_deadline(spark):
    held = rows(
        spark, "CustodyPositions", position("a", date(2025, 3, 31), CreatedAt=datetime(2025, 4, 1, 4)),
        position("b", date(2025, 4, 30), CreatedAt=datetime(2025, 5, 1, 4, 0, 1)),
    )
    found = {row.PositionPeriod.month: row.Status for row in contracts.snapshot_on_time(held).collect()}
    assert found == {3: "ON_TIME", 4: "LATE"}


def test_hashed_identifiers(spark):
    people = rows(spark, "Customers", client("a" * 64), client("A" * 64), client("C1"), client(None))
    assert sorted(row.CustomerId for row in contracts.customer_ids_hashed(people).collect()) == ["A" * 64, "C1"]


def log(spark, *events):
    return rows(spark, "FinancialEvents", *events)


def test_append_only_by_digest(spark):
    march = [event(f"m{k}", MARCH, GrossAmount=k) for k in range(20)]
    april = [event(f"a{k}", date(2025, 4, 1), GrossAmount=k) for k in range(20)]
    undated = event("u", None)
    before = log(spark, *march, *april, undated, march[0])
    assert contracts.append_only_by_digest(before, before.repartition(5)).count() == 0
    changed = [*march[1:], *april[2:], {**april[1], "Status": "edited"}, {**undated, "GrossAmount": None}, march[0], march[0], event("new", MARCH)]
    found = contracts.append_only_by_digest(before, log(spark, *changed))
    assert sorted(row.ID for row in found.collect()) == ["a0", "a1", "u"]
    assert sorted(map(str, found.collect())) == sorted(map(str, contracts.append_only(before, log(spark, *changed)).collect()))
    moved = [{**march[3], "PeriodDate": date(2025, 4, 1)}, *march[:3], *march[4:], *april, undated, march[0]]
    assert [row.ID for row in contracts.append_only_by_digest(before, log(spark, *moved)).collect()] == ["m3"]
    fewer = log(spark, *march, *april, undated)  # one of two equal rows is gone: the row is still there
    assert contracts.append_only_by_digest(before, fewer).count() == 0
    assert contracts.append_only_by_digest(before.limit(0), before).count() == 0
    assert contracts.append_only_by_digest(before, before.limit(0)).count() == before.count()


def test_equal_logs_are_read_once(spark, tmp_path):
    for name in ("before", "after"):
        log(spark, *[event(f"e{k}", MARCH) for k in range(50)]).write.parquet(f"{tmp_path}/{name}")
    before, after = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("before", "after"))
    same = contracts.append_only_by_digest(before, after)
    assert "Join" not in same._jdf.queryExecution().executedPlan().toString() and same.count() == 0
    stored = contracts.digests(before, "PeriodDate")
    edited = after.withColumn("Status", F.when(F.col("ID") == "e7", "x").otherwise(F.col("Status")))
    found = contracts.append_only_by_digest(before, edited, previous_digests=stored)
    assert [row.ID for row in found.collect()] == ["e7"]
    affected = found._jdf.queryExecution().optimizedPlan().toString()
    assert affected.count("LeftSemi") == 2  # only the range that differs is compared


def test_contract_report(spark):
    t = tables(
        spark,
        positions=[
            position("A", MARCH), position("A", MARCH, quantity=-1, asset="XRP"), position("B", MARCH, PriceUSD=None), position("C", date(2025, 3, 9), ref=None, client="a" * 64),
            position("D", date(2025, 3, 31), ref=None, value=99, CreatedAt=datetime(2025, 4, 1, 5)), position("E", date(2025, 3, 31), ref=None), position(None, None, AssetId=None),
        ],
    )
    report = contracts.contract_report(t, "CustodyPositions", F.lit("2025-04-01 18:00:00"))
    failing = {(row.CheckName, row.ColumnName): row.FailingCount for row in report.filter("Status = 'FAIL'").collect()}
    assert failing == {
        ("unique", "ID"): 1, ("relationship", "AssetId"): 1, ("accepted_range", "Quantity"): 1, ("not_null", "PriceUSD"): 1,
        ("not_null", "ID"): 1, ("not_null", "PositionDate"): 1, ("not_null", "AssetId"): 1,
        ("grain", "CustomerId, AssetId, PositionDate"): 2, ("valuation_consistent", "ValuationUSD"): 1, ("hashed", "CustomerId"): 6,
        ("period_end_reference", "CustodianLedgerRef"): 3, ("snapshot_on_time", "PositionDate"): 1,
    }
    status = {row.CheckName: row.Status for row in report.collect()}
    assert status["freshness"] == "WARN"  # 13 hours
    late = contracts.contract_report(t, "CustodyPositions", F.lit("2025-04-02 06:00:00")).filter("CheckName = 'freshness'").first()
    assert (late.Status, late.FailingCount) == ("FAIL", 1)
    for name in SCHEMAS:
        assert contracts.contract_report(t, name).filter("CheckName = 'column_type' AND Status = 'FAIL'").count() == 0
    assert contracts.contract_report(tables(spark), "CustodyPositions").filter("Status <> 'PASS'").count() == 0


def test_reward_type_is_part_of_the_grain(spark):
    kinds = [reward("a", MARCH, 1, RewardType="x"), reward("b", MARCH, 1, RewardType="y"), reward("c", MARCH, 1, RewardType="y"), reward("d", MARCH, 5, gross=9, RewardType="z")]
    report = contracts.contract_report(tables(spark, rewards=kinds), "StakingEvents")
    failing = {row.CheckName: (row.ColumnName, row.FailingCount) for row in report.filter("Status = 'FAIL'").collect()}
    assert failing == {"grain": ("CustomerId, AssetId, EarnDate, RewardType", 1), "net_reward_consistent": ("NetAmount", 1)}


def test_event_log_contract_compares_with_the_previous_state(spark):
    before = log(spark, event("a", MARCH), event("b", MARCH))
    report = contracts.contract_report({"FinancialEvents": log(spark, event("a", MARCH))}, "FinancialEvents", previous=before)
    assert {row.CheckName: row.FailingCount for row in report.filter("Status = 'FAIL'").collect()} == {"append_only": 1}


def test_a_contract_scans_its_table_twice(spark, tmp_path):
    t = tables(spark, positions=[position("A", MARCH)], rewards=[reward("S", MARCH, 1)], fees=[fee("F", MARCH)], events=[event("E", MARCH)])
    for name in SCHEMAS:
        t[name].write.parquet(f"{tmp_path}/{name}")
    stored = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in SCHEMAS}
    for name in SCHEMAS:
        plan = contracts.contract_report(stored, name, F.current_timestamp())._jdf.queryExecution().executedPlan().toString()
        assert 1 <= plan.count("FileScan parquet") <= 2 + (name == "CustodyPositions"), name  # positions look up the assets


def test_load_time_of_files(spark, tmp_path):
    tables(spark).Customers.write.parquet(f"{tmp_path}/c")
    loaded = with_load_time(spark.read.parquet(f"{tmp_path}/c"))
    now = F.current_timestamp()
    assert contracts.contract_freshness(loaded, "Customers", LOADED_AT, now).first().Status == "pass"
    assert contracts.contract_freshness(loaded, "Customers", LOADED_AT, now + F.expr("INTERVAL 50 HOURS")).first().Status == "warn"
    report = contracts.contract_report({"Customers": loaded}, "Customers", now + F.expr("INTERVAL 80 HOURS"), LOADED_AT)
    assert [row.CheckName for row in report.filter("Status <> 'PASS'").collect()] == ["freshness"]


def test_contract_report_names_missing_and_mistyped_columns(spark):
    t = tables(spark)
    people = t.Customers.drop("KycStatus").withColumn("IsActive", F.lit("yes"))
    problems = contracts.schema_differences(people, contracts.CONTRACTS["Customers"])
    assert problems == {"KycStatus": "missing", "IsActive": "expected BOOLEAN, found string"}
    report = contracts.contract_report({"Customers": people}, "Customers")
    failing = [row.ColumnName for row in report.filter("Status = 'FAIL'").collect()]
    assert sorted(failing) == ["IsActive", "KycStatus"]
