from datetime import date, datetime

import pytest

from closebook.operators import gate
from closebook.plans.books import Books
from closebook.plans.close import close_period, statement_period
from closebook.schemas import SCHEMAS, SemanticTables
from closebook.session import Scratch
from tests.samples import asset, books, client, event, fee, position, reward, rows, tables

MARCH = date(2025, 3, 1)
NAMES = [
    "all_fees_billed", "kyc_approved_only", "ledger_tieout_clean", "no_missing_positions", "no_pending_events",
    "reconciliation_clean",
]


def clean(**more):
    return {"positions": [position("P", date(2025, 3, 31))], "fees": [fee("F", MARCH)], "events": [event("E", MARCH)], **more}


def test_all_green(spark):
    result = gate.order_verdict(books(spark, **clean()).close_gate).collect()
    assert [row.CheckName for row in result] == NAMES
    assert {(row.FailingCount, row.Status, row.SampleExceptions) for row in result} == {(0, "PASS", "None")}
    assert all(row.Description for row in result)


def test_failing_checks_come_first_with_samples(spark):
    b = books(
        spark,
        positions=[position("P1", date(2025, 3, 31)), position("P2", date(2025, 3, 31), client="C2", ref=None)],
        fees=[fee("F1", MARCH), fee("F2", MARCH, status="accrued", kind="staking"), fee("F3", MARCH, status=None)],
        events=[event("E1", date(2025, 3, 9), status="PENDING")],
        clients=[client("C1"), client("C2", kyc="PENDING"), client("C3", kyc="SUSPENDED", active=False)],
    )
    result = {row.CheckName: row for row in gate.order_verdict(b.close_gate).collect()}
    assert list(result)[-1] == "no_missing_positions" and result["no_missing_positions"].Status == "PASS"
    failing = {name: (row.FailingCount, row.SampleExceptions) for name, row in result.items() if row.Status == "FAIL"}
    assert failing == {
        "all_fees_billed": (1, "C1 / ASSET_ETH / staking / 2025-03-01"),  # a NULL status does not fail
        "kyc_approved_only": (1, "Client C2 (KycStatus=PENDING)"),
        "ledger_tieout_clean": (
            1,
            "C2 / ASSET_ETH / 2025-03-01: UNCONFIRMED — No custodian ledger reference — position not confirmed by custodian",
        ),
        "no_pending_events": (1, "C1 / ASSET_ETH / 2025-03-01"),
        "reconciliation_clean": (
            2,
            "Client C1 / ETH / 2025-03-01: HasPendingEvents | Client C2 / ETH / 2025-03-01: UnbilledFees",
        ),
    }


def test_sample_lists_five_of_seven_and_skips_null_texts(spark):
    customers = rows(spark, "Customers", *[client(f"C{i}", kyc="PENDING") for i in range(7)], {**client("X", kyc="PENDING"), "CustomerName": None})
    row = gate.evaluate(customers, [gate.kyc_approved_only()]).first()
    assert row.FailingCount == 8
    assert row.SampleExceptions == " | ".join(f"Client C{i} (KycStatus=PENDING)" for i in range(5))


def test_sample_without_any_text_is_none(spark):
    customers = rows(spark, "Customers", {**client("X", kyc="PENDING"), "CustomerName": None})
    row = gate.evaluate(customers, [gate.kyc_approved_only()]).first()
    assert (row.FailingCount, row.Status, row.SampleExceptions) == (1, "FAIL", "None")


def test_require_green(spark):
    assert len(gate.require_green(books(spark, **clean()).close_gate)) == 6
    failing = books(spark, **clean(events=[event("E", MARCH, status="pending")])).close_gate
    with pytest.raises(gate.PeriodCloseFailed, match="2 close checks failed") as raised:
        gate.require_green(failing)
    assert [row.CheckName for row in raised.value.failures] == ["no_pending_events", "reconciliation_clean"]
    with pytest.raises(gate.PeriodCloseFailed, match="no rows"):
        gate.require_green(failing.limit(0))


def test_a_close_collects_no_invoice_lists(spark):
    def lists(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("listagg(InvoiceReference")

    b = Books(tables(spark, **clean()))
    assert lists(b.client_positions) > 0 and lists(b.reconciliation) > 0
    assert [lists(df) for df in (b.close_gate, b.monthly_statement)] == [0, 0]


class Scans:
    """Tables that count how often a task reads each of their rows."""

    def __init__(self, spark, t):
        self.rows = {name: spark.sparkContext.accumulator(0) for name in SCHEMAS}
        self.tables = SemanticTables(**{name: self._counting(t[name], self.rows[name]) for name in SCHEMAS})

    @staticmethod
    def _counting(df, counter):
        def run(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)


def test_a_green_close_reads_each_fact_once_and_draws_no_sample(spark, monkeypatch):
    days = [date(2025, 3, d) for d in range(1, 32)]
    given = {
        "positions": [position(f"P{k}", day) for k, day in enumerate(days)], "rewards": [reward("S1", MARCH, 1), reward("S2", MARCH, 2)],
        "fees": [fee(f"F{k}", MARCH) for k in range(7)], "events": [event(f"E{k}", MARCH) for k in range(11)],
        "clients": [client(f"C{k}") for k in range(1, 6)],
    }
    scans = Scans(spark, tables(spark, **given))
    monkeypatch.setattr(gate, "exceptions", lambda *_: pytest.fail("a green check was evaluated again"))
    with Scratch(spark) as scratch:
        b = Books(scans.tables, keep=scratch.keep, watch=gate.Watch())
        checks = gate.require_green(b.close_gate)
        assert [row.CheckName for row in checks] == NAMES
    read = {name: counter.value for name, counter in scans.rows.items()}
    assert {name: read[name] for name in ("FeeEvents", "FinancialEvents", "Customers", "StakingEvents")} == {
        "FeeEvents": 7, "FinancialEvents": 11, "Customers": 5, "StakingEvents": 2,
    }
    assert read["CustodyPositions"] == 2 * 31  # once for hot keys, once for the balances


def test_watched_checks_agree_with_the_lazy_gate(spark):
    given = {
        "positions": [position("P1", date(2025, 3, 31)), position("P2", date(2025, 3, 31), client="C2", ref=None), position("P3", MARCH, value=99, client="C3")],
        "fees": [fee("F1", MARCH), fee("F2", MARCH, status="accrued", kind="staking"), fee("F3", MARCH, status=None), fee("F4", MARCH, client="elsewhere", status="accrued")],
        "events": [event("E1", date(2025, 3, 9), status="PENDING"), event("E2", MARCH, client="elsewhere", status="pending"), event("E3", MARCH, client=None, status="pending")],
        "clients": [client("C1"), client("C2", kyc="PENDING"), client("C3", kyc="SUSPENDED", active=False)],
    }
    t = tables(spark, **given)
    with Scratch(spark) as scratch:
        watched = Books(t, keep=scratch.keep, watch=gate.Watch()).close_gate
        assert sorted(watched.collect()) == sorted(Books(t).close_gate.collect())
        assert watched.dtypes == Books(t).close_gate.dtypes


@pytest.mark.parametrize("missing", ["positions", "events"])
def test_a_check_whose_rows_nobody_read_is_evaluated(spark, monkeypatch, missing):
    """An empty table may remove whole branches from a plan; what they would have counted is not taken for zero."""
    monkeypatch.setattr(gate, "METRIC_SECONDS", 3)
    given = clean(events=[event("E", MARCH, status="pending")], fees=[fee("F", MARCH, status="accrued")], clients=[client("C1", kyc="PENDING")])
    t = tables(spark, **{**given, missing: []})
    with Scratch(spark) as scratch:
        watched = Books(t, keep=scratch.keep, watch=gate.Watch()).close_gate.collect()
        assert sorted(watched) == sorted(Books(t).close_gate.collect())
        failing = {row.CheckName for row in watched if row.Status == "FAIL"}
        assert ("no_pending_events" in failing) == (missing != "events")


@pytest.mark.parametrize(
    ("run", "period"), [(date(2025, 4, 2), MARCH), (date(2025, 1, 31), date(2024, 12, 1)), (date(2024, 3, 31), date(2024, 2, 1))]
)
def test_statement_period(run, period):
    assert statement_period(run) == period


def test_close_exports_only_when_green(spark, tmp_path):
    log = f"{tmp_path}/log"
    result = close_period(tables(spark, **clean()), datetime(2025, 4, 2, 6), f"{tmp_path}/out", log, entity="Bank")
    assert result.period == MARCH and result.exported_to.endswith("/out/2025-03-01") and len(result.checks) == 6
    exported = spark.read.option("header", True).csv(result.exported_to)
    assert exported.count() == 1 and exported.first().IssuingEntity == "Bank"
    close_period(tables(spark, **clean()), datetime(2025, 4, 2, 7), f"{tmp_path}/out", log)
    assert spark.read.parquet(log).count() == 1  # the second close logs nothing new

    broken = tables(spark, **clean(clients=[client("C1", kyc="PENDING")], assets=[asset("ETH")]))
    with pytest.raises(gate.PeriodCloseFailed):
        close_period(broken, datetime(2025, 4, 2, 6), f"{tmp_path}/never", log)
    assert not (tmp_path / "never").exists()
