"""Period-close checks: one row per check with a failing count and up to five samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from closebook import constants as K


@dataclass(frozen=True)
class Check:
    name: str
    failing: Column
    text: Column


def _joined(*parts: Column | str) -> Column:
    """Concatenation that is NULL when any part is NULL; strings are literals."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def evaluate(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate checks over the same rows, one result row per check.

    Counts are combined map-side, and the sample (the first failing texts in order) is limited to a few
    rows per task before anything is moved. Both read the same columns of ``rows`` without further
    filters, so that Spark shares the exchanges below them.
    """
    verdicts = [
        F.struct(F.lit(c.name).alias("CheckName"), c.failing.alias("failing"), c.text.alias("text")) for c in checks
    ]
    failing = rows.select(F.inline(F.array(*verdicts))).filter("failing").select("CheckName", "text")
    counts = failing.groupBy("CheckName").agg(
        F.count(F.lit(1)).alias("FailingCount"), F.count("text").alias("TextCount")
    )
    in_order = Window.partitionBy("CheckName").orderBy(F.asc_nulls_last("text"))
    first = failing.withColumn("position", F.row_number().over(in_order)).filter(F.col("position") <= K.SAMPLE_SIZE)
    samples = first.groupBy("CheckName").agg(
        F.expr("listagg(text, ' | ') WITHIN GROUP (ORDER BY text)").alias("Sample")
    )
    return (
        _check_names(rows, checks)
        .join(F.broadcast(counts), "CheckName", "left")
        .join(F.broadcast(samples), "CheckName", "left")
        .select(
            "CheckName",
            "Description",
            F.coalesce("FailingCount", F.lit(0)).cast("bigint").alias("FailingCount"),
            F.when(F.col("FailingCount") > 0, "FAIL").otherwise("PASS").alias("Status"),
            F.when(F.col("TextCount") > 0, F.col("Sample")).otherwise("None").alias("SampleExceptions"),
        )
    )


def _check_names(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Name and description of every check, also of those without a failing row."""
    texts = [F.struct(F.lit(c.name).alias("CheckName"), F.lit(K.CLOSE_CHECKS[c.name]).alias("Description")) for c in checks]
    return rows.sparkSession.range(1).select(F.inline(F.array(*texts)))


def _period_text(name: str) -> Column:
    return F.col(name).cast("string")


def reconciliation_clean() -> Check:
    status = F.col("ReconciliationStatus")
    text = _joined(
        F.col("CustomerName"), " / ", F.col("Symbol"), " / ", _period_text("PositionPeriod"), ": ", status
    )
    return Check("reconciliation_clean", status != K.RECONCILIATION_STATUSES[-1], text)


def no_missing_positions() -> Check:
    text = _joined(F.col("CustomerName"), " / ", F.col("Symbol"), " / ", _period_text("PositionPeriod"))
    return Check("no_missing_positions", F.col("ReconciliationStatus") == K.RECONCILIATION_STATUSES[0], text)


def ledger_tieout_clean() -> Check:
    status = F.col("LedgerStatus")
    detail = F.coalesce(_joined(" — ", F.col("ExceptionDetail")), F.lit(""))
    text = _joined(
        F.col("CustomerId"), " / ", F.col("AssetId"), " / ", _period_text("PositionPeriod"), ": ", status, detail
    )
    return Check("ledger_tieout_clean", status != K.LEDGER_STATUSES[-1], text)


def no_pending_events() -> Check:
    event, calc = "FinancialEvents", "FinancialEventsCalc"
    text = _joined(
        F.col(f"{event}.CustomerId"), " / ", F.col(f"{event}.AssetId"), " / ", _period_text(f"{calc}.EventPeriod")
    )
    return Check("no_pending_events", F.col(f"{calc}.IsPending"), text)


def all_fees_billed() -> Check:
    event, calc = "FeeEvents", "FeeEventsCalc"
    text = _joined(
        F.col(f"{event}.CustomerId"), " / ", F.col(f"{event}.AssetId"), " / ", F.col(f"{event}.FeeType"), " / ",
        _period_text(f"{calc}.FeePeriod"),
    )
    return Check("all_fees_billed", ~F.col(f"{calc}.IsFullyBilled"), text)


def kyc_approved_only() -> Check:
    text = _joined(F.col("CustomerName"), " (KycStatus=", F.col("KycStatus"), ")")
    return Check("kyc_approved_only", F.col("KycStatus") != K.APPROVED, text)


def active(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("IsActive"))


def period_close_gate(
    summary: DataFrame,
    tie_out: DataFrame,
    wide_financial: DataFrame,
    wide_fees: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """All six checks."""
    parts = [
        evaluate(summary, [reconciliation_clean(), no_missing_positions()]),
        evaluate(tie_out, [ledger_tieout_clean()]),
        evaluate(wide_financial, [no_pending_events()]),
        evaluate(wide_fees, [all_fees_billed()]),
        evaluate(active(customers), [kyc_approved_only()]),
    ]
    return reduce(DataFrame.unionByName, parts)


RESULT = "CheckName string, Description string, FailingCount bigint, Status string, SampleExceptions string"
METRIC_SECONDS = 20  # that the metrics of a finished job may take to arrive


def _metrics(observation: Observation) -> dict[str, int] | None:
    """The metrics, or None if none arrive: Spark drops an observed branch of a plan once it turns out to be empty."""
    found: list[dict] = []

    def wait() -> None:
        try:
            found.append(observation.get)
        except Exception:  # noqa: BLE001  the session may end while this waits for what never comes
            return

    waiting = Thread(target=wait, daemon=True)
    waiting.start()
    waiting.join(METRIC_SECONDS)
    return found[0] if found else None


def exceptions(rows: DataFrame, check: Check) -> tuple[int, str]:
    """Exact number of failing rows of a check, and the first texts in order."""
    failing = rows.filter(check.failing).select(check.text.alias("text"))
    first = failing.filter("text IS NOT NULL").orderBy("text").limit(K.SAMPLE_SIZE).collect()
    return failing.count(), " | ".join(row.text for row in first) or "None"


class Watch:
    """Close checks evaluated on rows that pass by while something else is made of them.

    ``over`` puts counters on a table; whoever then runs through all of its rows fills them. A check
    whose counter stays at zero has passed without a job or a scan of its own. A counter may count
    the rows of a repeated task again, after an executor was lost, but never misses a row, so a check
    that may fail is evaluated exactly, with its samples, and so is one whose rows nobody counted.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, str]] = {}
        self._exact: dict[str, tuple[DataFrame, Check]] = {}

    def over(self, rows: DataFrame, *checks: Check, failing: Column | None = None, where: Column | None = None) -> DataFrame:
        """``rows``, counted on the way.

        ``failing`` replaces the condition of the (only) check where these rows hold its inputs under other
        names, and ``where`` limits what is counted; the rows themselves stay as they are.
        """
        observation = Observation()
        counted = F.lit(True) if where is None else where
        counters = [F.count_if(counted & (check.failing if failing is None else failing)).alias(check.name) for check in checks]
        for check in checks:
            self._seen[check.name] = (observation, check.name)
        return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *counters)

    def exact(self, rows: DataFrame, *checks: Check) -> None:
        """Where checks are evaluated if their counters are not all zero."""
        for check in checks:
            self._exact[check.name] = (rows, check)

    def passed(self, name: str) -> bool:
        if name not in self._seen:
            return False
        observation, metric = self._seen[name]
        found = _metrics(observation)
        return bool(found) and found["rows"] > 0 and found[metric] == 0

    def verdict(self, spark: SparkSession) -> DataFrame:
        """One row per check, as :func:`period_close_gate`, from counters and, for what may fail, from the rows."""
        made = []
        for name, (rows, check) in self._exact.items():
            count, sample = (0, "None") if self.passed(name) else exceptions(rows, check)
            made.append(Row(CheckName=name, Description=K.CLOSE_CHECKS[name], FailingCount=count, Status="FAIL" if count else "PASS", SampleExceptions=sample))
        return spark.createDataFrame(made, RESULT)


def order_verdict(gate: DataFrame) -> DataFrame:
    """Failing checks first, then by name."""
    return gate.orderBy(F.when(F.col("Status") == "FAIL", 1).otherwise(2), "CheckName")


class PeriodCloseFailed(Exception):
    """The close gate is not green; ``failures`` holds the failing rows."""

    def __init__(self, message: str, failures: list) -> None:
        super().__init__(message)
        self.failures = failures


def require_green(gate: DataFrame) -> list:
    """Return the (at most six) check rows, or raise when one fails or there are none."""
    rows = order_verdict(gate).collect()
    if not rows:
        raise PeriodCloseFailed("the close gate returned no rows", [])
    failures = [row for row in rows if row.Status == "FAIL"]
    if failures:
        names = ", ".join(f"{row.CheckName} ({row.FailingCount})" for row in failures)
        raise PeriodCloseFailed(f"{len(failures)} close checks failed: {names}", failures)
    return rows
