from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closebook import session
from closebook.schemas import SCHEMAS
from closebook.sources import delivery, seeds, tables
from tests.samples import books, client, fee, position, reward
from tests.samples import tables as sample_tables

MARCH = date(2025, 3, 1)


def test_round_trip_of_all_tables(spark, tmp_path):
    t = sample_tables(spark, positions=[position("P", MARCH)], rewards=[reward("S", MARCH, 1)], fees=[fee("F", MARCH)])
    for name in SCHEMAS:
        tables.store(t[name], f"{tmp_path}/{name}")
        tables.store(t[name], f"{tmp_path}/{name}")  # a refresh replaces the rows
    read = tables.read_all(spark, str(tmp_path))
    for name in SCHEMAS:
        assert read[name].schema == SCHEMAS[name]
        assert sorted(map(str, read[name].collect())) == sorted(map(str, t[name].collect()))


def test_month_filter_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(1, MARCH), (2, date(2025, 4, 1))], "v int, PositionPeriod date")
    tables.store(rows, str(tmp_path), ["PositionPeriod"])
    march = spark.read.parquet(str(tmp_path)).filter(F.col("PositionPeriod") == F.lit(MARCH))
    assert [row.v for row in march.collect()] == [1]
    assert "PartitionFilters: [isnotnull(PositionPeriod" in march._jdf.queryExecution().executedPlan().toString()


def test_views_and_catalog_tables(spark):
    tables.as_view(spark.range(3), "three_rows")
    assert spark.sql("SELECT count(*) AS n FROM three_rows").first().n == 3


def test_conform_casts_to_the_declared_types(spark):
    raw = spark.sql("SELECT 'A' AS AssetId, 'S' AS Symbol, 'N' AS AssetName, 'T' AS AssetType, 'P' AS Protocol, 'true' AS IsStakeable, 3 AS UnbondingDays")
    conformed = tables.conform(raw, "ReferenceAssets")
    assert conformed.dtypes == spark.createDataFrame([], SCHEMAS["ReferenceAssets"]).dtypes


SEEDS = {
    "customers": "C-A,Alder,hedge_fund,CH,2020-06-30,approved,tier_3,True\nC-B,Birch,fund,SG,,pending_review,tier_2,False",
    "ref_assets": "A-X,XYZ,Xylo,made_up,Xylonet,True,0.5,11,xylo",
    "raw_custody_positions": "H-1,C-A,A-X,7.000000001,2.25,15.75,2024-11-30,L-9,2024-12-01 03:59:59",
    "raw_staking_events": "W-1,C-A,A-X,v-77,tip,0.5,0.125,0.375,2024-11-04,,,pending,e-3,1001,oracle,2024-11-05 00:00:00",
    "raw_financial_events": 'G-1,C-A,A-X,move,8.5,0.5,8.0,2024-11-07 23:15:00,2024-11-01,2024-11-09,settled,desk,custody,"{""k"": ""p, q""}",2024-11-07 23:15:01',
    "raw_fee_events": "B-1,C-A,A-X,desk_fee,3,12.5,41666.67,2024-11-01,2024-11-30,billed,,2024-12-02 08:00:00",
}


def header_of(seed):
    return ",".join(seeds.SEEDS[seed].names)


def test_seed_files(spark, tmp_path):
    for seed, lines in SEEDS.items():
        (tmp_path / f"{seed}.csv").write_text(f"{header_of(seed)}\n{lines}\n")
    t = seeds.read_seeds(spark, str(tmp_path))
    for name in SCHEMAS:
        assert t[name].schema == SCHEMAS[name]
    assert [row.IsActive for row in t.Customers.collect()] == [True, False]
    assert t.CustodyPositions.first().Quantity == Decimal("7.000000001")
    staking, event, charge = t.StakingEvents.first(), t.FinancialEvents.first(), t.FeeEvents.first()
    assert staking.SettleDate is None and staking.EarnDate == date(2024, 11, 4) and staking.RewardType == "tip"
    assert event.EventTimestamp == datetime(2024, 11, 7, 23, 15) and event.ProductLine == "custody"
    assert charge.InvoiceReference is None and charge.AumAtBilling == Decimal("41666.67")
    meta = seeds.read_seed(spark, "raw_financial_events", f"{tmp_path}/raw_financial_events.csv").first().metadata_json
    assert meta == '{"k": "p, q"}'
    for seed in SEEDS:  # the checked load gives the same rows
        loaded = seeds.load_seed(spark, seed, f"{tmp_path}/{seed}.csv", f"{tmp_path}/rejects")
        read = seeds.read_seed(spark, seed, f"{tmp_path}/{seed}.csv")
        assert loaded.dtypes == read.dtypes and loaded.collect() == read.collect()


def test_malformed_seed_lines_raise(spark, tmp_path):
    (tmp_path / "ref_assets.csv").write_text(f"{header_of('ref_assets')}\nA-X,XYZ,Xylo,made_up,Xylonet,True,0.5,many,xylo\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        seeds.read_seed(spark, "ref_assets", f"{tmp_path}/ref_assets.csv").collect()


@pytest.mark.parametrize("read", [seeds.read_seed, lambda spark, seed, path: seeds.load_seed(spark, seed, path, f"{path}-rejects")])
def test_a_swapped_header_raises(spark, tmp_path, read):
    names = header_of("ref_assets").split(",")
    names[1], names[2] = names[2], names[1]
    (tmp_path / "ref_assets.csv").write_text(f"{','.join(names)}\n{SEEDS['ref_assets']}\n")
    with pytest.raises(Exception, match="header|CSV"):
        read(spark, "ref_assets", f"{tmp_path}/ref_assets.csv").collect()


def test_bad_lines_are_listed_and_may_fail_the_load(spark, tmp_path):
    good = SEEDS["raw_fee_events"]
    bad = {
        "basis_points: not a whole number": good.replace(",3,", ",3.5,"), "fee_amount_usd: not a number": good.replace("12.5", "12,5").replace('12,5', '"12,5"'),
        "fee_period_end: not a date": good.replace("2024-11-30", "2024-11-31"), "created_at: not a time": good.replace(" 08:00:00", ""),
        "wrong number of fields": good + ",extra",
    }
    path, rejects = f"{tmp_path}/raw_fee_events.csv", f"{tmp_path}/rejects"
    (tmp_path / "raw_fee_events.csv").write_text("\n".join([header_of("raw_fee_events"), good, *bad.values(), "B-2" + "," * 11]) + "\n")
    loaded = seeds.load_seed(spark, "raw_fee_events", path, rejects, max_rejects=5)
    assert [row.fee_id for row in loaded.orderBy("fee_id").collect()] == ["B-1", "B-2"]
    assert loaded.filter("fee_id = 'B-2' AND created_at IS NULL AND fee_type IS NULL").count() == 1
    listed = {row.Reason: row for row in seeds.read_rejects(spark, rejects).collect()}
    assert listed.keys() == bad.keys() and {row.Seed for row in listed.values()} == {"raw_fee_events"}
    assert all(row.Line.startswith("B-1,C-A,A-X,desk_fee,") and row.File.endswith("/raw_fee_events.csv") for row in listed.values())
    assert listed["wrong number of fields"].Line == good + ",extra"
    with pytest.raises(seeds.SeedRejected, match="5 lines"):
        seeds.load_seed(spark, "raw_fee_events", path, rejects, max_rejects=4)
    assert seeds.read_rejects(spark, rejects).count() == 10  # those of the failed load are listed as well


def test_flags_are_true_or_false(spark, tmp_path):
    (tmp_path / "c.csv").write_text(header_of("customers") + "\n" + "\n".join(f"C{k},n,t,j,,k,r,{flag}" for k, flag in enumerate(["True", "FALSE", "yes", "1", ""])) + "\n")
    loaded = seeds.load_seed(spark, "customers", f"{tmp_path}/c.csv", f"{tmp_path}/r", max_rejects=2)
    assert {row.customer_id: row.is_active for row in loaded.collect()} == {"C0": True, "C1": False, "C4": None}


def test_catalog_tables(spark):
    t = sample_tables(spark, positions=[position("P", MARCH)])
    spark.sql("CREATE DATABASE IF NOT EXISTS closebook_test")
    for name in SCHEMAS:
        tables.store_table(t[name], f"closebook_test.{name}")
        tables.store_table(t[name], f"closebook_test.{name}")  # a refresh replaces the rows
    read = tables.read_catalog(spark, "closebook_test")
    assert all(sorted(map(str, read[name].collect())) == sorted(map(str, t[name].collect())) for name in SCHEMAS)
    spark.sql("DROP DATABASE closebook_test CASCADE")


def statement_of(spark):
    return books(
        spark,
        positions=[position("P1", date(2025, 3, 31)), position("P2", date(2025, 4, 30)), position("P3", date(2025, 3, 31), client="C2")],
        clients=[client("C1"), client("C2")],
    ).monthly_statement


def test_export_keeps_the_order(spark, tmp_path):
    target = delivery.export_statements(statement_of(spark), str(tmp_path), MARCH)
    assert target.endswith("/2025-03-01")
    lines = [row.CustomerName + row.PeriodLabel for row in spark.read.option("header", True).csv(target).coalesce(1).collect()]
    assert lines == ["Client C1March 2025", "Client C1April 2025", "Client C2March 2025"]


def test_export_per_client_writes_the_closed_month(spark, tmp_path):
    target = delivery.export_per_client(statement_of(spark), str(tmp_path), MARCH)
    folders = sorted(path.name for path in (tmp_path / "period=2025-03-01").iterdir() if path.is_dir())
    assert folders == ["client_id=C1", "client_id=C2"]
    assert spark.read.option("header", True).csv(target).count() == 2


def test_a_client_with_many_rows_gets_several_files(spark, tmp_path):
    held = [position(f"P{i}", date(2025, 3, 31), quantity=i, ref=f"R{i}") for i in range(40)]
    held.append(position("Q", date(2025, 3, 31), client="C2"))
    b = books(spark, positions=held, clients=[client("C1"), client("C2")])
    target = delivery.export_per_client(b.monthly_statement, str(tmp_path), MARCH, hot_rows=10)
    files = {name: len(list((tmp_path / "period=2025-03-01" / f"client_id={name}").glob("*.csv"))) for name in ("C1", "C2")}
    assert files["C1"] > 1 and files["C2"] == 1
    assert spark.read.option("header", True).csv(target).count() == 41


def test_delivery_log_is_idempotent(spark, tmp_path):
    path, now = f"{tmp_path}/log", F.lit("2025-04-02 06:00:00")
    statement = statement_of(spark)
    delivery.record_deliveries(statement.filter("CustomerId = 'C1'"), path, now)
    delivery.record_deliveries(statement.union(statement), path, now, status="RESENT")
    log = delivery.read_log(statement, path).collect()
    assert sorted((row.CustomerId, row.DeliveryStatus) for row in log) == [("C1", "SENT"), ("C1", "SENT"), ("C2", "RESENT")]


class FakeSession:
    """Only what the choice of a folder looks at."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_paths_follow_the_configured_folder():
    cluster = FakeSession("yarn", "hdfs:///shared/")
    first, second = session.scratch_path(cluster, "x"), session.scratch_path(cluster, "x")
    assert first.startswith("hdfs:///shared/closebook/x-") and first != second
    assert session.shared_dir(FakeSession("local[2]", None)) == session.shared_dir(FakeSession("local[2]", None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn", None))


def test_materialise_cuts_lineage(spark):
    kept = session.materialise(spark.range(5), "five")
    assert kept.count() == 5 and "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_scratch_tables_are_deleted(spark):
    with session.Scratch(spark) as scratch:
        kept = scratch.keep(spark.range(5), "five")
        assert kept.count() == 5 and len(scratch.paths) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(scratch.paths[0])
