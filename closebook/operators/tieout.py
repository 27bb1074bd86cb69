"""Tie-out of computed balances against the custodian's ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook import constants as K
from closebook.functions import numeric
from closebook.operators.views import KEYS, rank_in


def _restated(quantity: str, price: str) -> Column:
    return F.round(numeric.multiply(F.col(quantity), F.col(price)), 2)


def _off(valuation: str, restated: Column) -> Column:
    return F.abs(numeric.subtract(F.col(valuation), restated)) > F.lit(K.LEDGER_TOLERANCE_USD)


def unmatched() -> Column:
    """Whether a balance does not tie out, from the columns of the balances."""
    restated = _restated("PeriodEndQuantity", "PeriodEndPriceUSD")
    return F.col("CustodianLedgerRef").isNull() | F.coalesce(_off("PeriodEndValuationUSD", restated), F.lit(False))


def ledger_tie_out(balances: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Restate quantity times price and compare with the reported valuation (unordered)."""
    difference = numeric.subtract(F.col("ComputedValuationUSD"), F.col("RestatedValuationUSD"))
    variance, unconfirmed, matched = K.LEDGER_STATUSES
    no_reference = F.col("CustodianLedgerRef").isNull()
    off = _off("ComputedValuationUSD", F.col("RestatedValuationUSD"))

    rows = balances.select(
        *KEYS,
        "PeriodEndDate",
        F.col("PeriodEndQuantity").alias("ComputedQuantity"),
        F.col("PeriodEndPriceUSD").alias("PriceUSD"),
        F.col("PeriodEndValuationUSD").alias("ComputedValuationUSD"),
        "CustodianLedgerRef",
    ).withColumn("RestatedValuationUSD", _restated("ComputedQuantity", "PriceUSD"))
    return rows.select(
        *KEYS, "PeriodEndDate", "ComputedQuantity", "PriceUSD", "ComputedValuationUSD", "RestatedValuationUSD",
        F.round(difference, 2).alias("VarianceUSD"),
        "CustodianLedgerRef",
        F.when(no_reference, unconfirmed).when(off, variance).otherwise(matched).alias("LedgerStatus"),
        F.when(no_reference, K.UNCONFIRMED_TEXT)
        .when(off, F.concat(F.lit(K.VARIANCE_TEXT), numeric.plain_text(F.abs(difference))))
        .alias("ExceptionDetail"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("ReconRunAt"),
    )


def order_tie_out(rows: DataFrame) -> DataFrame:
    """Variances first, then unconfirmed, then matched rows; last columns only break ties."""
    return rows.orderBy(
        rank_in("LedgerStatus", K.LEDGER_STATUSES), *KEYS, "CustodianLedgerRef", "ComputedValuationUSD"
    )
