"""Benchmark of the headline queries; prints one JSON line.

The semantic tables are derived from the test tables once and stored as Parquet (reported as
``semantic_tables``), because that is what a close reads. Every query is then run in full into the
no-op sink, three times; the median counts. ``calcs_joined`` builds one calc table by a join per calc
and is only there for comparison with ``calcs_fused``; ``value`` leaves it out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.fixture import semantic_tables  # noqa: E402
from closebook.functions.calcs import calcs_of  # noqa: E402
from closebook.operators import gate, statement, tieout, views  # noqa: E402
from closebook.operators.assembly import micro_calc  # noqa: E402
from closebook.operators.reports import CUSTODY_MONTHLY  # noqa: E402
from closebook.plans.books import Books  # noqa: E402
from closebook.schemas import FACTS, SCHEMAS, SemanticTables  # noqa: E402
from closebook.session import local_session, materialise, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def stored_tables(spark) -> SemanticTables:
    folder = scratch_path(spark, "bench")
    source = semantic_tables(spark, SF_DIR)
    for name in SCHEMAS:
        source[name].write.parquet(f"{folder}/{name}")
    return SemanticTables(**{name: spark.read.parquet(f"{folder}/{name}") for name in SCHEMAS})


def calcs_joined(t: SemanticTables) -> DataFrame:
    tables = [micro_calc(t.FeeEvents, calc) for calc in calcs_of("FeeEventsCalc")]
    return reduce(lambda left, right: left.join(right, "ID", "left"), tables, t.FeeEvents.select("ID"))


def stored_close(t: SemanticTables) -> DataFrame:
    """Gate and statement over layers that are written once, with the checks counted on the way, as a close does."""
    books = Books(t, keep=materialise, watch=gate.Watch())
    books.close_gate.collect()
    return statement.order_statement(books.monthly_statement)


def headline(t: SemanticTables) -> dict[str, Callable[[], DataFrame]]:
    return {
        "calcs_fused": lambda: Books(t).calc("FeeEvents"),
        "calcs_joined": lambda: calcs_joined(t),
        **{f"wide_{name}": lambda name=name: Books(t).wide(name) for name in FACTS},
        "custody_balances": lambda: Books(t).balances,
        "staking_rewards": lambda: Books(t).staking_rewards,
        "fee_accruals": lambda: Books(t).fee_accruals,
        "client_positions": lambda: Books(t).client_positions,
        "reconciliation_summary": lambda: views.order_reconciliation(Books(t).reconciliation),
        "ledger_tieout": lambda: tieout.order_tie_out(Books(t).tie_out),
        "period_close_gate": lambda: Books(t).close_gate,
        "monthly_statement": lambda: statement.order_statement(Books(t).monthly_statement),
        "report_custody_monthly": lambda: Books(t).report(CUSTODY_MONTHLY),
        "stored_close": lambda: stored_close(t),
    }


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, memory="16g")
    found: list[SemanticTables] = []
    seconds = {"semantic_tables": timed(lambda: found.append(stored_tables(spark)))}
    for name, query in headline(found[0]).items():
        runs = [timed(lambda: query().write.format("noop").mode("overwrite").save()) for _ in range(RUNS)]
        seconds[name] = statistics.median(runs)
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    total = sum(value for name, value in seconds.items() if name != "calcs_joined")
    result = {
        "metric": "headline queries, sum of medians", "value": round(total, 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
