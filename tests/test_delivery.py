"""Report files per client, the log of deliveries, and the close of one month."""

import csv
import hashlib
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from closebook.operators import gate, reports
from closebook.plans.close import MONTHLY, close_month, close_period
from closebook.sources import delivery, tables
from tests.samples import client, event, fee, position, reward
from tests.samples import tables as sample_tables

MARCH, APRIL = date(2025, 3, 1), date(2025, 4, 1)
CONFIG = {
    "report_id": "r",
    "client_filters": [{"field": "KycStatus", "operator": "equals", "value": "APPROVED"}],
    "columns": [
        {"name": "Symbol", "label": "Asset", "order": 1}, {"name": "Amount", "label": "Amount", "order": 2},
        {"name": "Reward", "label": "Reward", "order": 3, "include_if": "IsStakeable = true"},
    ],
    "delivery": {"format": "csv", "filename_template": "st_{client_id}_{period}.csv", "destination_path": "/out/{period}/"},
}
SOURCE = "CustomerId string, KycStatus string, IsStakeable boolean, PositionPeriod date, Symbol string, Amount decimal(38,9), Reward int"


def source(spark, rows):
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(CustomerId, KycStatus, IsStakeable, PositionPeriod, Symbol, Amount, Reward)").select(
        *[F.col(part.split()[0]).cast(part.split()[1]) for part in SOURCE.split(", ")]
    )


ROWS = [
    "('C1', 'APPROVED', true, DATE'2025-03-01', 'ETH', 0.000000001, 5)", "('C1', 'APPROVED', false, DATE'2025-03-01', 'BTC', 0, 5)",
    "('a/b *%é', 'APPROVED', true, DATE'2025-03-01', 'x,\"y\"', 12345678901234567890, 7)", "('C1', 'APPROVED', true, DATE'2025-04-01', 'ETH', 9, 5)",
    "('C2', 'PENDING', true, DATE'2025-03-01', 'ETH', 1, 5)",
]


def read(path):
    with open(path, newline="", encoding="utf-8") as file:
        return list(csv.reader(file))


def test_report_files_have_the_configured_names(spark, tmp_path):
    manifest = delivery.deliver_report(CONFIG, source(spark, ROWS), str(tmp_path), MARCH).collect()
    folder = tmp_path / "out" / "2025-03-01"
    names = sorted(p.name for p in folder.iterdir() if not p.name.startswith((".", "_")))
    assert names == ["st_C1_2025-03-01.csv", "st_a%2Fb+%2A%25%C3%A9_2025-03-01.csv"]
    assert read(folder / names[0]) == [["Symbol", "Amount", "Reward"], ["BTC", "0.000000000", ""], ["ETH", "0.000000001", "5"]]
    assert read(folder / names[1])[1] == ['x,"y"', "12345678901234567890.000000000", "7"]
    assert sorted((r.CustomerId, r.File, r.Rows) for r in manifest) == [("C1", names[0], 2), ("a/b *%é", names[1], 1)]
    for r in manifest:
        content = (folder / r.File).read_bytes()
        assert (r.Bytes, r.Sha256) == (len(content), hashlib.sha256(content).hexdigest())


def test_a_second_delivery_replaces_the_first(spark, tmp_path):
    delivery.deliver_report(CONFIG, source(spark, ROWS), str(tmp_path), MARCH)
    other = tmp_path / "out" / "2025-04-01" / "keep.txt"
    other.parent.mkdir(parents=True)
    other.write_text("x")
    manifest = delivery.deliver_report(CONFIG, source(spark, ROWS[:2]), str(tmp_path), MARCH)
    assert [r.CustomerId for r in manifest.collect()] == ["C1"] and other.exists()
    assert len(list((tmp_path / "out" / "2025-03-01").glob("*.csv"))) == 1
    assert delivery.deliver_report(CONFIG, source(spark, ROWS[4:]), str(tmp_path), MARCH).count() == 0


def test_a_client_with_many_rows_gets_numbered_files(spark, tmp_path):
    many = source(spark, ROWS).crossJoin(spark.range(200)).filter("CustomerId = 'C1' OR id = 0").withColumn("Amount", F.col("id").cast("decimal(38,9)"))
    manifest = delivery.deliver_report(CONFIG, many, str(tmp_path), MARCH, file_rows=100).collect()
    files = sorted((r.File, r.Rows) for r in manifest if r.CustomerId == "C1")
    assert [f for f, _ in files] == ["st_C1_2025-03-01.2.csv", "st_C1_2025-03-01.3.csv", "st_C1_2025-03-01.4.csv", "st_C1_2025-03-01.csv"]
    assert sum(n for _, n in files) == 400
    for r in manifest:
        rows = read(tmp_path / "out" / "2025-03-01" / r.File)
        assert len(rows) == r.Rows + 1 and rows[0] == ["Symbol", "Amount", "Reward"]
        symbols = [row[0] for row in rows[1:]]
        assert symbols == sorted(symbols)


def test_what_cannot_be_delivered_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="without a client"):
        delivery.deliver_report(CONFIG, source(spark, ["(NULL, 'APPROVED', true, DATE'2025-03-01', 'ETH', 1, 5)"]), str(tmp_path), MARCH)
    for wrong, text in (({"format": "pdf"}, "pdf"), ({"filename_template": "all_{period}.csv"}, "client_id")):
        with pytest.raises(ValueError, match=text):
            delivery.deliver_report({**CONFIG, "delivery": {**CONFIG["delivery"], **wrong}}, source(spark, ROWS), str(tmp_path), MARCH)
    assert not (tmp_path / "out").exists()


def statements(spark, *keys):
    return spark.createDataFrame([(k, f"C{k}", MARCH) for k in keys], "StatementId string, CustomerId string, PositionPeriod date")


def at(hour):
    return F.lit(datetime(2025, 4, 2, hour)).cast("timestamp")


def state(spark, path):
    found = delivery.current_state(delivery.read_log(spark.range(1), path)).collect()
    return {r.StatementId: (r.DeliveryStatus, r.Attempt, r.Events) for r in found}


def test_failed_attempts_are_repeated_until_confirmed(spark, tmp_path):
    path, rows = f"{tmp_path}/log", statements(spark, "a", "b", "c")
    outcomes = spark.createDataFrame([("a", False), ("b", True)], "StatementId string, Delivered boolean")
    for _ in range(2):  # a run that is repeated, with its own time, adds nothing
        delivery.record_deliveries(rows, path, at(6), outcomes=outcomes)
        assert state(spark, path) == {"a": ("FAILED", 1, 1), "b": ("SENT", 1, 1), "c": ("SENT", 1, 1)}
    receipts = spark.createDataFrame([("b", datetime(2025, 4, 2, 7)), ("b", datetime(2025, 4, 2, 5)), ("a", datetime(2025, 4, 2, 7)), ("z", None)], "StatementId string, ReceivedAt timestamp")
    for _ in range(2):
        delivery.confirm_deliveries(receipts, path)
        assert state(spark, path) == {"a": ("FAILED", 1, 1), "b": ("CONFIRMED", 1, 2), "c": ("SENT", 1, 1)}
    log = delivery.read_log(rows, path)
    assert sorted(r.StatementId for r in delivery.unexpected_receipts(log, receipts).collect()) == ["a", "z"]
    delivery.record_deliveries(rows, path, at(8), outcomes=outcomes)
    assert state(spark, path)["a"] == ("FAILED", 2, 2)
    delivery.record_deliveries(rows, path, at(9))
    assert state(spark, path) == {"a": ("SENT", 3, 3), "b": ("CONFIRMED", 1, 2), "c": ("SENT", 1, 1)}
    delivery.confirm_deliveries(receipts, path)
    assert state(spark, path)["a"] == ("CONFIRMED", 3, 4)
    confirmed = delivery.current_state(delivery.read_log(rows, path)).filter("StatementId = 'a'").first()
    assert confirmed.AttemptedAt == datetime(2025, 4, 2, 9)  # the receipt bears an earlier time than the attempt


def test_a_crashed_append_is_repeated(spark, tmp_path):
    path, rows = f"{tmp_path}/log", statements(spark, "a", "b", "c", "d")
    outcomes = spark.createDataFrame([("a", False)], "StatementId string, Delivered boolean")
    events = delivery.pending_deliveries(rows, delivery.read_log(rows, path), at(6), outcomes=outcomes)
    # Two of four events became visible, one of them twice.
    for part in ("StatementId IN ('a', 'b')", "StatementId = 'a'"):
        events.filter(part).write.mode("append").partitionBy("PositionPeriod").parquet(path)
    delivery.record_deliveries(rows, path, at(6), outcomes=outcomes)
    assert state(spark, path) == {"a": ("FAILED", 1, 1), "b": ("SENT", 1, 1), "c": ("SENT", 1, 1), "d": ("SENT", 1, 1)}


def test_events_without_attempts_are_first_attempts(spark, tmp_path):
    path, rows = f"{tmp_path}/log", statements(spark, "a", "b")
    old = rows.withColumn("DeliveryStatus", F.when(F.col("StatementId") == "a", "SENT").otherwise("FAILED")).withColumn("AttemptedAt", at(1))
    old.write.partitionBy("PositionPeriod").parquet(path)
    delivery.record_deliveries(rows, path, at(6))
    assert state(spark, path) == {"a": ("SENT", 1, 1), "b": ("SENT", 2, 2)}


def test_equal_times_are_decided_by_rank(spark):
    rows = [("a", "Ca", s, datetime(2025, 4, 2, 6), 1, s, MARCH) for s in ("CONFIRMED", "FAILED", "SENT")]
    log = spark.createDataFrame(rows, delivery.LOG_SCHEMA)
    assert delivery.current_state(log).first().DeliveryStatus == "CONFIRMED"


def two_months(spark, **more):
    given = {
        "positions": [
            position("P0", date(2025, 2, 28), quantity=1), position("P1", date(2025, 3, 31)), position("P2", date(2025, 4, 30), quantity=5),
            position("P3", date(2025, 3, 30), client="C2"),
        ],
        "rewards": [reward("S0", date(2025, 2, 3), 3), reward("S1", date(2025, 3, 3), 4)],
        "fees": [fee("F1", MARCH), fee("F2", MARCH, client="C2"), fee("F3", APRIL, status="accrued")],
        "events": [event("E1", MARCH), event("E2", APRIL, status="pending")],
        "clients": [client("C1", CustomerType="HEDGE_FUND"), client("C2", CustomerType="FAMILY_OFFICE")], **more,
    }
    return sample_tables(spark, **given)


def test_one_month_is_closed_over_its_own_files(spark, tmp_path):
    stored, books, log = (f"{tmp_path}/{name}" for name in ("stored", "books", "log"))
    tables.store_by_month(two_months(spark), stored)
    read_part = tables.read_months(spark, stored, MARCH)
    for name, months in tables.needed_months(MARCH).items():
        plan = read_part[name]._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
        assert "Month#" in filters and all(str(m) in filters or str((m - date(1970, 1, 1)).days) in filters for m in months), filters
    assert sorted(r.ID for r in read_part.CustodyPositions.collect()) == ["P0", "P1", "P3"]
    assert sorted(r.ID for r in read_part.FeeEvents.collect()) == ["F1", "F2"]

    # April has open items; they do not stand in the way of March.
    result = close_month(spark, stored, MARCH, datetime(2025, 4, 2, 6), books, f"{tmp_path}/sent", log, entity="Bank")
    assert len(result.checks) == 6 and result.delivered_to.endswith("/statements/custody/monthly/2025-03-01")
    rows = {name: spark.read.parquet(f"{books}/{name}").collect() for name in MONTHLY}
    assert {name: len(found) for name, found in rows.items()} == dict.fromkeys(MONTHLY, 2)
    assert {r.PositionPeriod for found in rows.values() for r in found} == {MARCH}
    [first] = [r for r in rows["MonthlyCustodyStatement"] if r.CustomerId == "C1"]
    assert (first.QuantityChangePeriodOverPeriod, first.PriorPeriodSettledNetRewards, first.IssuingEntity) == (1, 3, "Bank")
    assert "AllInvoiceReferences" in rows["ReconciliationSummary"][0].asDict()
    assert [r.CustomerId for r in spark.read.parquet(log).collect()] == ["C1"]  # the report leaves out family offices
    with pytest.raises(gate.PeriodCloseFailed, match="all_fees_billed"):
        close_month(spark, stored, APRIL, datetime(2025, 5, 2, 6), books)
    assert sorted(p.name for p in (tmp_path / "books" / "MonthlyCustodyStatement").iterdir() if p.is_dir()) == ["PositionPeriod=2025-03-01"]


def test_other_months_files_stay_untouched(spark, tmp_path):
    def rows(*months):
        return spark.createDataFrame([(k, m) for k, m in enumerate(months)], "v int, PositionPeriod date")

    path = f"{tmp_path}/table"
    for month in (MARCH, APRIL):
        tables.replace_month(rows(MARCH, APRIL, APRIL), path, month)
    march = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "PositionPeriod=2025-03-01").iterdir()}
    tables.replace_month(rows(MARCH, APRIL), path, APRIL)
    found = sorted((r.v, r.PositionPeriod) for r in spark.read.parquet(path).collect())
    assert found == [(0, MARCH), (1, APRIL)]
    tables.replace_month(rows(MARCH), path, APRIL)  # a month without rows is gone
    assert {r.PositionPeriod for r in spark.read.parquet(path).collect()} == {MARCH}
    assert march == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "PositionPeriod=2025-03-01").iterdir()}


def test_a_close_delivers_its_report(spark, tmp_path):
    t = two_months(
        spark, fees=[fee("F0", date(2025, 2, 1)), fee("F1", MARCH), fee("F2", MARCH, client="C2"), fee("F3", APRIL)], events=[event("E1", MARCH)]
    )
    log = f"{tmp_path}/log"
    result = close_period(t, datetime(2025, 4, 2, 6), f"{tmp_path}/out", log, report_root=f"{tmp_path}/sent")
    manifest = spark.read.parquet(f"{result.delivered_to}/{delivery.MANIFEST}").collect()
    assert [(r.CustomerId, r.File, r.Rows) for r in manifest] == [("C1", "custody_statement_C1_2025-03-01.csv", 1)]
    [header, line] = read(tmp_path / "sent" / "statements" / "custody" / "monthly" / "2025-03-01" / manifest[0].File)
    assert header == [spec["name"] for spec in reports.CUSTODY_MONTHLY["columns"]]
    assert dict(zip(header, line, strict=True))["PeriodEndQuantity"] == "2.000000000"
    logged = spark.read.parquet(log).collect()
    assert [r.StatementId for r in logged] == [dict(zip(header, line, strict=True))["StatementId"]]


def test_appending_reads_the_log_without_sorting_out_repeated_events(spark, tmp_path):
    rows, path = statements(spark, "A", "B"), f"{tmp_path}/log"
    delivery.record_deliveries(rows, path, at(6))
    spark.read.parquet(path).write.mode("append").partitionBy("PositionPeriod").parquet(path)  # as after a crash
    assert "Aggregate" not in delivery._events(rows, path)._jdf.queryExecution().optimizedPlan().toString()
    delivery.record_deliveries(rows, path, at(7))
    receipts = rows.select("StatementId", at(8).alias("ReceivedAt"))
    delivery.confirm_deliveries(receipts, path)
    found = delivery.current_state(delivery.read_log(rows, path)).collect()
    assert sorted((row.Attempt, row.Events, row.DeliveryStatus) for row in found) == [(1, 2, "CONFIRMED")] * 2


def test_identifiers_of_events_are_made_where_they_are_written(spark, tmp_path):
    rows, path = statements(spark, "A", "B"), f"{tmp_path}/log"
    delivery.record_deliveries(rows.filter("StatementId = 'A'"), path, at(6))
    log = delivery._events(rows, path)
    receipts = rows.select("StatementId", at(8).alias("ReceivedAt"))
    for events in (delivery._pending(rows, log, at(7), "SENT", None), delivery._confirmed(log, receipts)):
        plan = events._jdf.queryExecution().optimizedPlan().toString()
        assert "EventId" not in events.columns and "sha2" not in plan and "LeftAnti" not in plan
    state = delivery.read_log(rows, path).drop("EventId")._jdf.queryExecution().executedPlan().toString()
    assert "EventId" not in state
    assert delivery.pending_deliveries(rows, log, at(7)).first().EventId == hashlib.sha256(b"B|2025-03-01|1|SENT").hexdigest()


def test_a_statement_without_identifier_is_logged_once(spark, tmp_path):
    rows, path = statements(spark, None, "A").union(statements(spark, None)), f"{tmp_path}/log"
    outcomes = spark.createDataFrame([(None, False)], "StatementId string, Delivered boolean")
    for hour in (6, 7):
        delivery.record_deliveries(rows, path, at(hour), outcomes=outcomes)
        assert sorted(map(str, (r.StatementId for r in spark.read.parquet(path).collect()))) == ["A", "None"]


def contents(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*.csv") if not any(part.startswith((".", "_")) for part in p.relative_to(folder).parts)}


def test_tasks_write_the_files_that_spark_would_write(spark, tmp_path, monkeypatch):
    odd = [*ROWS, "('', 'APPROVED', NULL, DATE'2025-03-01', '', NULL, NULL)", "('C1', 'APPROVED', true, DATE'2025-03-01', ' #a\\nb''\\\\', -1, 5)"]
    found = {}
    for way in ("tasks", "spark"):
        if way == "spark":  # as where only Spark's writer reaches the folder
            monkeypatch.setattr(delivery, "_local", lambda spark, folder: None)
        else:  # no file may take the way over the driver
            monkeypatch.setattr(delivery, "_move_files", None)
        manifest = delivery.deliver_report(CONFIG, source(spark, odd), f"{tmp_path}/{way}", MARCH).collect()
        found[way] = contents(tmp_path / way), sorted(map(tuple, manifest))
        monkeypatch.undo()
    assert found["tasks"] == found["spark"] and len(found["tasks"][0]) == 3


def test_client_folders_are_those_that_spark_would_write(spark, tmp_path, monkeypatch):
    clients = ["C1", "C2", "a/b *%é", "x=[1]:\t'", "", None]
    rows = [(c, MARCH, f"S{n}", f"L{n}", f"s,\"{n}\"" if n % 2 else None, n) for n, c in enumerate(clients * 3)] + [("C9", APRIL, "S", "L", "s", 0)]
    given = spark.createDataFrame(rows, "CustomerId string, PositionPeriod date, StatementId string, CustodianLedgerRef string, Symbol string, n int")
    found = {}
    for way in ("tasks", "spark"):
        if way == "spark":
            monkeypatch.setattr(delivery, "_local", lambda spark, folder: None)
        for _ in range(2):  # the second run replaces the first
            target = delivery.export_per_client(given, f"{tmp_path}/{way}", MARCH)
        read_back = spark.read.option("header", True).csv(target).collect()
        files = contents(tmp_path / way)
        found[way] = sorted((name.rsplit("/", 1)[0], sorted(text.splitlines())) for name, text in files.items()), sorted(map(str, read_back))
        assert (tmp_path / way / "period=2025-03-01" / "_SUCCESS").exists() and len(read_back) == 18
    assert found["tasks"] == found["spark"] and len(found["tasks"][0]) >= 5
    crc = [p for p in (tmp_path / "tasks").rglob("*.crc") if "SUCCESS" not in p.name]
    assert not crc, "Spark's writer made these files"
