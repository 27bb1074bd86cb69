"""Source contracts: what each semantic table must satisfy before a close.

The single checks return violating rows (no rows means pass). ``contract_report`` runs everything a
table's contract declares and returns one row per check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook import constants as K
from closebook.functions import numeric
from closebook.operators.skew import broadcast_if_small


DIGEST_RANGES = 256  # per month, of two snapshots that are compared


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count; keys with a NULL are not compared."""
    keys = [columns] if isinstance(columns, str) else list(columns)
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter("row_count > 1")


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent row."""
    known = broadcast_if_small(parent.select(F.col(parent_column).alias(column)))
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(df.columns)


def at_least(df: DataFrame, column: str, minimum: int = 0) -> DataFrame:
    return df.filter(F.col(column) < minimum)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def period_end_reference_present(balances: DataFrame) -> DataFrame:
    """Balances (the last snapshot of a month) without a ledger reference."""
    return not_null(balances, "CustodianLedgerRef")


def valuation_consistent(positions: DataFrame) -> DataFrame:
    """Positions valued more than a cent away from quantity times price."""
    return positions.filter(_valuation_off())


def _valuation_off() -> Column:
    expected = numeric.multiply(F.col("Quantity"), F.col("PriceUSD"))
    return F.abs(numeric.subtract(F.col("ValuationUSD"), expected)) > F.lit(K.LEDGER_TOLERANCE_USD)


def net_reward_consistent(staking: DataFrame) -> DataFrame:
    """Rewards whose gross minus fee is not the net amount."""
    return staking.filter(_net_reward_off())


def _net_reward_off() -> Column:
    expected = numeric.subtract(F.col("GrossAmount"), F.col("FeeAmount"))
    return F.abs(numeric.subtract(F.col("NetAmount"), expected)) > F.lit(K.REWARD_TOLERANCE)


def invoice_reference_present(fees: DataFrame, invoiced: str = K.BILLING_STATUSES[0]) -> DataFrame:
    return fees.filter(_invoice_missing(invoiced))


def _invoice_missing(invoiced: str = K.BILLING_STATUSES[0]) -> Column:
    return (F.col("BillingStatus") == invoiced) & F.col("InvoiceReference").isNull()


def freshness(df: DataFrame, loaded_at: str, run_ts: Column, warn_hours: int, error_hours: int) -> DataFrame:
    """One row: newest load time, its age in whole hours and pass, warn or error (no data is an error)."""
    latest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("LatestLoad"))
    seconds = F.unix_timestamp(run_ts.cast("timestamp")) - F.unix_timestamp("LatestLoad")
    return latest.select(
        "LatestLoad",
        F.floor(seconds / 3600).cast("bigint").alias("AgeHours"),
        F.when(F.col("LatestLoad").isNull() | (seconds > error_hours * 3600), "error")
        .when(seconds > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("Status"),
    )


def contract_freshness(df: DataFrame, name: str, loaded_at: str, run_ts: Column) -> DataFrame:
    """Freshness of a table against the limits of its contract."""
    limits = CONTRACTS[name]
    return freshness(df, loaded_at, run_ts, limits.warn_hours, limits.error_hours)


def append_only(previous: DataFrame, current: DataFrame, key: str = "ID") -> DataFrame:
    """Rows of the previous snapshot that are no longer present unchanged; a row without a key never is."""
    columns = previous.columns
    unchanged = [F.col(f"before.{name}").eqNullSafe(F.col(f"after.{name}")) for name in columns if name != key]
    same = reduce(Column.__and__, unchanged, F.col(f"before.{key}") == F.col(f"after.{key}"))
    return previous.alias("before").join(current.select(columns).alias("after"), same, "left_anti")


def digests(log: DataFrame, period: str, key: str = "ID", ranges: int = DIGEST_RANGES) -> DataFrame:
    """One row per month and range of the key's hash: number of rows and two sums of independent row hashes.

    Sums do not depend on the order of rows, and equal rows do not cancel out. The table is small (months
    times ``ranges``), so it can be stored beside a snapshot and spare reading that again.
    """
    columns = sorted(log.columns)

    def total(seed: int) -> Column:
        parts = [F.lit(seed), *[F.struct(F.col(f"`{name}`").isNull(), F.col(f"`{name}`")) for name in columns]]
        return F.sum(F.xxhash64(*parts).cast("decimal(20,0)"))

    place = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")
    return log.groupBy(F.trunc(period, "MM").alias("DigestMonth"), place.alias("DigestRange")).agg(
        F.count(F.lit(1)).alias("RowCount"), total(1).alias("Digest1"), total(2).alias("Digest2")
    )


def append_only_by_digest(
    previous: DataFrame,
    current: DataFrame,
    period: str = "PeriodDate",
    key: str = "ID",
    ranges: int = DIGEST_RANGES,
    previous_digests: DataFrame | None = None,
) -> DataFrame:
    """As :func:`append_only`, but rows are compared only in the months and key ranges whose digests differ.

    Rows appended to the current month change the digests of that month alone, so the closed months are read once, in
    order to be summed up, and not joined. ``previous_digests`` are those of :func:`digests` for ``previous``,
    if they were stored. A changed range is missed only if its row count and both 64-bit sums agree by
    accident, a chance of 2**-128 for each; :func:`append_only` is exact.
    """
    columns = previous.columns
    now = current.select(*columns)
    before = digests(previous, period, key, ranges) if previous_digests is None else previous_digests
    same = ["RowCount", "Digest1", "Digest2"]
    after = digests(now, period, key, ranges)
    joined = before.alias("b").join(
        after.alias("a"),
        reduce(Column.__and__, [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("DigestMonth", "DigestRange")]), "full",
    )
    differs = ~reduce(Column.__and__, [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in same])
    found = joined.filter(differs).select(
        *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in ("DigestMonth", "DigestRange")]
    )
    # At most months times ranges rows of two numbers, collected so that equal logs start no join at all.
    changed = found.collect()
    if not changed:
        return previous.limit(0)
    spark = previous.sparkSession
    where = broadcast_if_small(spark.createDataFrame(changed, found.schema).withColumnsRenamed({"DigestMonth": "_m", "DigestRange": "_r"}))

    def affected(df: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")
        match = F.trunc(period, "MM").eqNullSafe(F.col("_m")) & (place == F.col("_r"))
        return df.join(where, match, "left_semi")

    return append_only(affected(previous), affected(now), key)


def snapshot_deadline(period: str) -> Column:
    """04:00 UTC on the first day after the month (session time zone UTC)."""
    return F.add_months(period, 1).cast("timestamp") + F.expr("INTERVAL 4 HOURS")


def snapshot_on_time(positions: DataFrame, loaded_at: str = "CreatedAt") -> DataFrame:
    """Per month: when its positions were last loaded, the deadline, and ON_TIME or LATE.

    Positions without a date belong to no month and have no deadline; ``not_null`` reports them.
    """
    loads = positions.filter("PositionDate IS NOT NULL").groupBy(F.trunc("PositionDate", "MM").alias("PositionPeriod")).agg(
        F.max(F.col(loaded_at).cast("timestamp")).alias("LoadedAt")
    )
    deadline = snapshot_deadline("PositionPeriod")
    status = F.when(F.col("LoadedAt") > deadline, "LATE").otherwise("ON_TIME")
    return loads.select("PositionPeriod", "LoadedAt", deadline.alias("Deadline"), status.alias("Status"))


def customer_ids_hashed(df: DataFrame, column: str = "CustomerId") -> DataFrame:
    """Rows whose client identifier is not a lowercase SHA-256 digest."""
    return df.filter(_not_hashed(column))


def _not_hashed(column: str) -> Column:
    return ~F.col(column).rlike("^[0-9a-f]{64}$")


@dataclass(frozen=True)
class ColumnRule:
    kind: str
    not_null: bool = True
    unique: bool = False
    minimum: int | None = None
    values: tuple[str, ...] | None = None
    parent: tuple[str, str] | None = None
    critical: bool = True


@dataclass(frozen=True)
class Contract:
    grain: tuple[str, ...]
    warn_hours: int
    error_hours: int
    columns: dict[str, ColumnRule] = field(default_factory=dict)
    #: Rules over several columns of a row: name, the column they are reported under, the columns they need, condition.
    rows: tuple[tuple[str, str, tuple[str, ...], Callable[[], Column]], ...] = ()
    #: Whether the last snapshot of a month needs a ledger reference, and by a deadline.
    period_end: bool = False


_ID = ColumnRule("STRING", unique=True)
_TEXT = ColumnRule("STRING")
_AMOUNT = ColumnRule("NUMERIC")
_AMOUNT_FROM_ZERO = ColumnRule("NUMERIC", minimum=0)
_DATE = ColumnRule("DATE")
_FLAG = ColumnRule("BOOLEAN")

# Grains, freshness limits (hours) and column rules of the source contracts.
CONTRACTS = {
    "CustodyPositions": Contract(
        ("CustomerId", "AssetId", "PositionDate"), 12, 24,
        {
            "ID": _ID,
            "CustomerId": _TEXT,
            "AssetId": ColumnRule("STRING", parent=("ReferenceAssets", "AssetId")),
            "PositionDate": _DATE,
            "Quantity": _AMOUNT_FROM_ZERO,
            "PriceUSD": _AMOUNT_FROM_ZERO,
            "ValuationUSD": _AMOUNT,
            "CustodianLedgerRef": ColumnRule("STRING", not_null=False),
        },
        (
            ("valuation_consistent", "ValuationUSD", ("Quantity", "PriceUSD", "ValuationUSD"), _valuation_off),
            ("hashed", "CustomerId", ("CustomerId",), lambda: _not_hashed("CustomerId")),
        ),
        period_end=True,
    ),
    "StakingEvents": Contract(
        ("CustomerId", "AssetId", "EarnDate", "RewardType"), 6, 12,
        {
            "ID": _ID,
            "CustomerId": _TEXT,
            "AssetId": _TEXT,
            "GrossAmount": _AMOUNT_FROM_ZERO,
            "NetAmount": _AMOUNT,
            "FeeAmount": _AMOUNT_FROM_ZERO,
            "RewardState": ColumnRule("STRING", values=K.REWARD_STATES),
            "EarnDate": _DATE,
        },
        (("net_reward_consistent", "NetAmount", ("GrossAmount", "FeeAmount", "NetAmount"), _net_reward_off),),
    ),
    "FeeEvents": Contract(
        ("CustomerId", "AssetId", "FeeType", "FeePeriodStart"), 24, 48,
        {
            "ID": _ID,
            "CustomerId": _TEXT,
            "AssetId": _TEXT,
            "FeeType": ColumnRule("STRING", values=K.FEE_TYPES, critical=False),
            "FeeAmountUSD": _AMOUNT_FROM_ZERO,
            "BillingStatus": ColumnRule("STRING", values=K.BILLING_STATUSES),
            "InvoiceReference": ColumnRule("STRING", not_null=False, critical=False),
        },
        (("invoice_reference", "InvoiceReference", ("BillingStatus", "InvoiceReference"), _invoice_missing),),
    ),
    "FinancialEvents": Contract(
        ("ID",), 1, 4,
        {
            "ID": _ID,
            "CustomerId": _TEXT,
            "AssetId": _TEXT,
            "EventType": _TEXT,
            "GrossAmount": _AMOUNT,
            "NetAmount": _AMOUNT,
            "PeriodDate": _DATE,
            "Status": _TEXT,
        },
    ),
    "Customers": Contract(
        ("CustomerId",), 48, 72,
        {
            "CustomerId": _ID,
            "CustomerName": _TEXT,
            "KycStatus": ColumnRule("STRING", values=K.KYC_STATUSES),
            "IsActive": _FLAG,
        },
    ),
    "ReferenceAssets": Contract(
        ("AssetId",), 7 * 24, 14 * 24,
        {"AssetId": _ID, "Symbol": _ID, "AssetName": _TEXT, "IsStakeable": _FLAG},
    ),
}

_SPARK_TYPES = {
    "STRING": T.StringType,
    "NUMERIC": T.DecimalType,
    "DATE": T.DateType,
    "BOOLEAN": T.BooleanType,
}


def schema_differences(df: DataFrame, contract: Contract) -> dict[str, str]:
    """Required columns that are missing or of another type (metadata only, no job)."""
    actual = {column.name: column.dataType for column in df.schema}
    problems = {}
    for name, rule in contract.columns.items():
        if name not in actual:
            problems[name] = "missing"
        elif not isinstance(actual[name], _SPARK_TYPES[rule.kind]):
            problems[name] = f"expected {rule.kind}, found {actual[name].simpleString()}"
    return problems


def _row(check: str, column: str, critical: bool, failing: Column, warn: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("CheckName"),
        F.lit(column).alias("ColumnName"),
        F.lit(critical).alias("Critical"),
        failing.cast("bigint").alias("FailingCount"),
        F.coalesce(F.lit(False) if warn is None else warn, F.lit(False)).alias("Warn"),
    )


def _repeats(df: DataFrame, contract: Contract, sets: Mapping[str, tuple[str, ...]], loaded_at: str | None) -> DataFrame:
    """One row: how many keys of each set of columns occur more than once, and what follows from groups of positions.

    All sets are counted in one expanded aggregate over one scan. Its groups are then summed up in two
    steps: balances (client, asset, month) first, for their last day, and everything else in one group per set.
    """
    month = F.trunc("PositionDate", "MM")
    keys = list(dict.fromkeys(name for columns in sets.values() for name in columns))
    source = df.select(*keys, *[c for c in ("CustodianLedgerRef",) if contract.period_end], *([loaded_at] if loaded_at and loaded_at not in keys else []))
    if contract.period_end:
        sets = {**sets, "_months": ("_month",)}
        source, keys = source.withColumn("_month", month), [*keys, "_month"]
    number = {name: sum(1 << (len(keys) - 1 - k) for k, key in enumerate(keys) if key not in columns) for name, columns in sets.items()}
    measures = [F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")]
    if contract.period_end:
        measures.append(F.count_if(F.col("CustodianLedgerRef").isNull()).alias("_missing"))
        measures.append(F.max(F.col(loaded_at).cast("timestamp") if loaded_at else F.lit(None).cast("timestamp")).alias("_loaded"))
    groups = source.groupingSets([[F.col(c) for c in columns] for columns in sets.values()], *keys).agg(*measures)

    def of(name: str) -> Column:
        return F.col("_set") == number[name]

    repeated = {name: of(name) & (F.col("_rows") > 1) & reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]) for name, columns in sets.items()}
    counters = [F.count_if(bad).alias(name) for name, bad in repeated.items() if name != "_months"]
    if not contract.period_end:
        return groups.agg(*counters)
    balance = [F.when(of("grain"), value) for value in (F.col("CustomerId"), F.col("AssetId"), month)]
    whole = of("grain") & F.col("CustomerId").isNotNull() & F.col("AssetId").isNotNull() & F.col("PositionDate").isNotNull()
    late = of("_months") & F.col("_month").isNotNull() & (F.col("_loaded") > snapshot_deadline("_month"))
    by_balance = groups.groupBy("_set", *[b.alias(f"_b{k}") for k, b in enumerate(balance)]).agg(
        *counters, F.max_by(F.when(whole, F.col("_missing")), F.when(whole, F.col("PositionDate"))).alias("_unreferenced"), F.count_if(late).alias("_late")
    )
    return by_balance.agg(
        *[F.sum(name).alias(name) for name in repeated if name != "_months"],
        F.sum("_unreferenced").alias("_unreferenced"), F.sum("_late").alias("_late"),
    )


def contract_report(
    tables: Mapping[str, DataFrame],
    name: str,
    run_ts: Column | None = None,
    loaded_at: str | None = None,
    previous: DataFrame | None = None,
) -> DataFrame:
    """One row per declared check of a table: TableName, CheckName, ColumnName, Critical, FailingCount, Status.

    Everything decided row by row, and the newest load, is found in one aggregate over the table, and all keys that must not repeat
    in another: two scans. ``loaded_at`` is the column with load times (for positions ``CreatedAt`` by
    default); with it and ``run_ts`` freshness is checked, which may also be WARN, and for positions the
    deadline of period-end snapshots. With the ``previous`` state of the table its rows must still be
    there unchanged (:func:`append_only_by_digest`, at once when this is called). Checks on columns that are missing or of another type are left out; ``column_type`` names these.
    """
    df, contract = tables[name], CONTRACTS[name]
    problems = schema_differences(df, contract)
    usable = {column: rule for column, rule in contract.columns.items() if column not in problems}
    if loaded_at is None and contract.period_end and "CreatedAt" in df.columns:
        loaded_at = "CreatedAt"

    marked, failing = df, {}
    for column, rule in usable.items():
        value = F.col(column)
        if rule.not_null:
            failing["not_null", column] = value.isNull()
        if rule.minimum is not None:
            failing["accepted_range", column] = value < rule.minimum
        if rule.values:
            failing["accepted_values", column] = ~value.isin(*rule.values)
        if rule.parent:
            parent, key = rule.parent
            known = tables[parent].select(F.col(key).alias("_parent")).filter("_parent IS NOT NULL").distinct().withColumn("_known", F.lit(True))
            marked = marked.join(broadcast_if_small(known), F.col(column) == F.col("_parent"), "left").drop("_parent")
            marked = marked.withColumnRenamed("_known", f"_known_{column}")
            failing["relationship", column] = value.isNotNull() & F.col(f"_known_{column}").isNull()
    for check, column, needed, condition in contract.rows:
        if set(needed) <= set(usable):
            failing[check, column] = condition()
    latest = F.max(F.col(loaded_at).cast("timestamp") if loaded_at else F.lit(None).cast("timestamp"))
    counts = marked.agg(latest.alias("_latest"), *[F.count_if(bad).alias(f"{check}|{column}") for (check, column), bad in failing.items()])

    sets = {column: (column,) for column, rule in usable.items() if rule.unique}
    if len(contract.grain) > 1 and not set(contract.grain) - set(df.columns):
        sets["grain"] = contract.grain
    period_end = contract.period_end and "grain" in sets and "CustodianLedgerRef" in usable

    def critical(column: str) -> bool:
        return column not in contract.columns or contract.columns[column].critical

    rows = [_row(check, column, critical(column), F.col(f"`{check}|{column}`")) for check, column in failing]
    rows += [_row("column_type", column, rule.critical, F.lit(int(column in problems))) for column, rule in contract.columns.items()]
    if run_ts is not None and loaded_at:
        age = F.unix_timestamp(run_ts.cast("timestamp")) - F.unix_timestamp("_latest")
        stale = F.col("_latest").isNull() | (age > contract.error_hours * 3600)
        rows.append(_row("freshness", loaded_at, True, stale.cast("int"), age > contract.warn_hours * 3600))
    if previous is not None:
        gone = append_only_by_digest(previous, df).count()
        rows.append(_row("append_only", "ID", True, F.lit(gone)))
    report = counts.select(F.inline(F.array(*rows)))

    rows = []
    for key in sets:
        check, column = ("grain", ", ".join(contract.grain)) if key == "grain" else ("unique", key)
        rows.append(_row(check, column, critical(column), F.coalesce(F.col(key), F.lit(0))))
    if period_end:
        rows.append(_row("period_end_reference", "CustodianLedgerRef", True, F.coalesce("_unreferenced", F.lit(0))))
        if loaded_at:
            rows.append(_row("snapshot_on_time", "PositionDate", True, F.coalesce("_late", F.lit(0))))
    if sets:
        repeats = _repeats(df, replace(contract, period_end=period_end), sets, loaded_at if period_end else None)
        report = report.unionByName(repeats.select(F.inline(F.array(*rows))))
    return report.select(
        F.lit(name).alias("TableName"),
        "CheckName", "ColumnName", "Critical", "FailingCount",
        F.when(F.col("FailingCount") > 0, "FAIL").when(F.col("Warn"), "WARN").otherwise("PASS").alias("Status"),
    )
