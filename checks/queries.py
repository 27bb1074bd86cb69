"""Every registered query with its SQL counterpart.

``QUERIES`` maps a name to a function of (spark, folder of test tables); ``ORACLES`` maps it to SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture, oracle
from closebook import constants as K
from closebook.functions.calcs import REGISTRY
from closebook.operators import contracts, gate, quality, reports, statement, tieout, views
from closebook.operators.assembly import calc_table, join_calc_tables, micro_calc, wide_table
from closebook.plans.books import Books
from closebook.plans.bucketed import BucketedBooks
from closebook.plans.close import close_month, close_period
from closebook.schemas import FACTS, SCHEMAS, SemanticTables
from closebook.session import COMPACT, configure, hadoop_path, materialise, scratch_path
from closebook.sources import delivery, seeds, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_AT = datetime(2001, 12, 1, 6, 0)
CLOSED_MONTH = date(1998, 6, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Amounts as DOUBLE, as on the SQL side."""
    return df.select(
        *[
            F.col(column.name).cast("double").alias(column.name)
            if isinstance(column.dataType, T.DecimalType)
            else F.col(column.name)
            for column in df.schema
        ]
    )


def register(name: str, query: Callable[[SemanticTables], DataFrame], sql: str | None) -> None:
    """Register a query over the semantic tables; the SQL may use every name in checks.oracle."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(fixture.semantic_tables(configure(spark), sf_dir)))

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = oracle.with_views(sql)


def bucketed(t: SemanticTables, **options: int) -> BucketedBooks:
    """Books over bucketed tables in the shared folder, as many buckets as shuffle partitions."""
    spark = t.Customers.sparkSession
    folder, buckets = scratch_path(spark, "bucketed"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketedBooks(t, f"closebook_{uuid4().hex}", buckets, folder, keep=materialise, **options)


def snake(name: str) -> str:
    """ValuationUSDRounded -> valuation_usd_rounded."""
    return re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def stored(t: SemanticTables) -> Books:
    """Books that write the shared intermediates once, for results that read the spine repeatedly."""
    return Books(t, keep=materialise)


def spark_of(t: SemanticTables) -> SparkSession:
    return t.Customers.sparkSession


# Scans: every table is stored in its declared types and read by the library's readers.
def _scanned(t: SemanticTables, name: str) -> DataFrame:
    path = scratch_path(spark_of(t), "scan")
    tables.store(tables.conform(t[name], name), f"{path}/{name}")
    return tables.read_semantic(spark_of(t), name, path)


for _table in SCHEMAS:
    _amounts = oracle.AMOUNTS.get(_table)
    register(
        f"scan_{snake(_table)}",
        lambda t, name=_table: _scanned(t, name),
        f"SELECT {oracle._doubles(*_amounts) if _amounts else '*'} FROM {_table}",
    )


def _catalog(t: SemanticTables) -> DataFrame:
    """Rewards over the six tables of a catalog database."""
    spark = spark_of(t)
    database = f"closebook_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for name in SCHEMAS:
        tables.store_table(tables.conform(t[name], name), f"{database}.{name}")
    return Books(tables.read_catalog(spark, database)).staking_rewards


register("scan_catalog", _catalog, f"SELECT {oracle._doubles(*oracle.REWARD_SUMS)} FROM Rew")

# Micro-calcs, assembled calc tables and widetables.
for _table in FACTS:
    _group = f"{_table}Calc"
    for _name, _calc in sorted(REGISTRY[_group].items()):
        register(
            f"calc_{snake(_name)}",
            lambda t, table=_table, calc=_calc: micro_calc(t[table], calc, {"ReferenceAssets": t.ReferenceAssets}),
            f"SELECT ID, {oracle.CALCS[_table][_name]} AS {_name} FROM {_table}",
        )
    register(
        f"calcs_{snake(_table)}",
        lambda t, table=_table: Books(t).calc(table),
        f"SELECT ID, {oracle.calc_columns(_table)} FROM {_table}",
    )

    def _flat(wide: DataFrame, table: str = _table, group: str = _group) -> DataFrame:
        fields = wide.schema[table].dataType.names
        calcs = [name for name in wide.schema[group].dataType.names if name != "ID"]
        return wide.select(
            *[F.col(f"{table}.{name}") for name in fields],
            *[F.col(f"{group}.{name}").alias(f"calc_{name}") for name in calcs],
        )

    register(f"wide_{snake(_table)}", lambda t, table=_table, flat=_flat: flat(Books(t).wide(table)), oracle.wide(_table))
    register(
        f"wide_joined_{snake(_table)}",
        lambda t, table=_table, flat=_flat: flat(join_calc_tables(t[table], Books(t).calc(table), f"{table}Calc")),
        oracle.wide(_table),
    )


def _unknown_asset_calcs(t: SemanticTables) -> DataFrame:
    """Staking calcs against a reference without the zero-day assets: unknown asset gives NULL."""
    known = t.ReferenceAssets.filter("UnbondingDays > 0")
    return calc_table(t.StakingEvents, "StakingEventsCalc", {"ReferenceAssets": known})


register(
    "calcs_staking_unknown_asset",
    _unknown_asset_calcs,
    "SELECT ID, "
    + ", ".join(
        f"{sql.replace('r.AssetId = StakingEvents.AssetId', 'r.AssetId = StakingEvents.AssetId AND r.UnbondingDays > 0')} AS {name}"
        for name, sql in sorted(oracle.CALCS["StakingEvents"].items())
    )
    + " FROM StakingEvents",
)

# Business views.
_BALANCES_SQL = f"SELECT {oracle._doubles(*oracle.BALANCE_AMOUNTS)} FROM Bal"
register("custody_balances", lambda t: Books(t).balances, _BALANCES_SQL)
register("staking_rewards", lambda t: Books(t).staking_rewards, f"SELECT {oracle._doubles(*oracle.REWARD_SUMS)} FROM Rew")
register(
    "fee_accruals",
    lambda t: Books(t).fee_accruals,
    "SELECT "
    + oracle._doubles("TotalFeeAmountUSD", "TotalAumBilled", "BilledFeeAmountUSD", "PendingFeeAmountUSD")
    + " FROM Fee",
)
register(
    "fees_collapsed",
    lambda t: views.fees_collapsed(Books(t).fee_accruals),
    f"SELECT {oracle._doubles('TotalFeesUSD', 'BilledFeesUSD', 'PendingFeesUSD')} FROM FeeSum",
)
register(
    "client_positions",
    lambda t: Books(t).client_positions.drop("_BuiltAt"),
    f"SELECT {oracle._doubles(*oracle.SPINE_AMOUNTS)} FROM Spine",
)
register(
    "financial_event_totals",
    lambda t: Books(t).event_totals,
    f"SELECT {oracle._doubles('SumGrossFromEvents', 'SumNetFromEvents')} FROM Totals",
)
_RECON_SQL = f"SELECT {oracle._doubles(*oracle.RECON_AMOUNTS)} FROM Recon"
register(
    "reconciliation_summary",
    lambda t: views.order_reconciliation(Books(t).reconciliation).drop("ReconciliationRunAt"),
    _RECON_SQL,
)
# The same in one lazy plan, with every key of two rows or more treated as hot and salted.
register(
    "reconciliation_summary_salted",
    lambda t: Books(t, hot_rows=1).reconciliation.drop("ReconciliationRunAt"),
    _RECON_SQL,
)
register(
    "ledger_tieout",
    lambda t: tieout.order_tie_out(Books(t).tie_out).drop("ReconRunAt"),
    f"SELECT {oracle._doubles(*oracle.TIE_AMOUNTS)} FROM Tie",
)

# Close checks.
_CHECK_ROWS: Mapping[str, tuple[Callable[[Books], DataFrame], Callable[[], gate.Check]]] = {
    "reconciliation_clean": (lambda b: b.reconciliation, gate.reconciliation_clean),
    "ledger_tieout_clean": (lambda b: b.tie_out, gate.ledger_tieout_clean),
    "no_pending_events": (lambda b: b.wide("FinancialEvents"), gate.no_pending_events),
    "all_fees_billed": (lambda b: b.wide("FeeEvents"), gate.all_fees_billed),
    "no_missing_positions": (lambda b: b.reconciliation, gate.no_missing_positions),
    "kyc_approved_only": (lambda b: gate.active(b.tables.Customers), gate.kyc_approved_only),
}
for _name, (_rows, _check) in _CHECK_ROWS.items():
    register(
        f"check_{_name}",
        lambda t, rows=_rows, check=_check: gate.evaluate(rows(Books(t)), [check()]),
        oracle.CHECKS[_name],
    )
_GATE_SQL = " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in oracle.CHECKS.values())
register("period_close_gate", lambda t: stored(t).close_gate, _GATE_SQL)
# The same, counted while balances, spine and reconciliation are written.
register("period_close_gate_watched", lambda t: Books(t, keep=materialise, watch=gate.Watch()).close_gate, _GATE_SQL)
register("gate_verdict", lambda t: gate.order_verdict(Books(t).close_gate), _GATE_SQL)

# Statement and reports.
_STATEMENT_SQL = f"SELECT {oracle._doubles(*oracle.STATEMENT_AMOUNTS)} FROM Stmt"
register(
    "monthly_statement",
    lambda t: statement.order_statement(Books(t).monthly_statement).drop("StatementGeneratedAt"),
    _STATEMENT_SQL,
)
register(
    "monthly_statement_salted",
    lambda t: Books(t, hot_rows=1).monthly_statement.drop("StatementGeneratedAt"),
    _STATEMENT_SQL,
)
# The same over bucketed tables: by client; and by client, asset and month, with every key of two rows or more apart from them.
register("monthly_statement_bucketed", lambda t: bucketed(t).monthly_statement.drop("StatementGeneratedAt"), _STATEMENT_SQL)
register(
    "monthly_statement_bucketed_salted",
    lambda t: bucketed(t, hot_rows=1).monthly_statement.drop("StatementGeneratedAt"),
    _STATEMENT_SQL,
)
register("reconciliation_bucketed", lambda t: bucketed(t).reconciliation.drop("ReconciliationRunAt"), _RECON_SQL)
register(
    "prior_period_join",
    lambda t: statement.with_prior_period(statement.approved_only(Books(t).client_positions)).select(
        *views.KEYS, "PeriodEndValuationUSD", "PriorPeriodQuantity", "PriorPeriodValuationUSD"
    ),
    """SELECT c.CustomerId, c.AssetId, c.PositionPeriod, CAST(c.PeriodEndValuationUSD AS DOUBLE) AS PeriodEndValuationUSD
            , CAST(p.PeriodEndQuantity AS DOUBLE) AS PriorPeriodQuantity
            , CAST(p.PeriodEndValuationUSD AS DOUBLE) AS PriorPeriodValuationUSD
         FROM (SELECT * FROM Spine WHERE KycStatus = 'APPROVED') c LEFT JOIN (SELECT * FROM Spine WHERE KycStatus = 'APPROVED') p
           ON p.CustomerId = c.CustomerId AND p.AssetId = c.AssetId
          AND date_diff('month', p.PositionPeriod, c.PositionPeriod) = 1""",
)
_REPORT_SOURCE = "(SELECT s.*, c.KycStatus, c.IsActive FROM Stmt s LEFT JOIN Customers c USING (CustomerId))"
_REPORT_SQL = (
    f"SELECT {oracle.report_columns()} FROM {_REPORT_SOURCE} WHERE KycStatus = 'APPROVED' AND IsActive "
    "AND CustomerType IN ('INSTITUTIONAL', 'HEDGE_FUND', 'ASSET_MANAGER', 'PENSION_FUND')"
)
register("report_custody_monthly", lambda t: stored(t).report(reports.CUSTODY_MONTHLY), _REPORT_SQL)
# A report over another source.
_OPEN_FEES = {
    "report_id": "open_fees",
    "source_model": "ClientPeriodPositions",
    "client_filters": [{"field": "KycStatus", "operator": "not_equals", "value": "SUSPENDED"}],
    "columns": [
        {"name": "CustomerId", "label": "Client", "order": 1},
        {"name": "Symbol", "label": "Asset", "order": 2},
        {"name": "PositionPeriod", "label": "Month", "order": 3},
        {"name": "KycStatus", "label": "KYC", "order": 4},
        {"name": "PeriodEndValuationUSD", "label": "Value (USD)", "order": 5},
        {"name": "PendingFeesUSD", "label": "Open Fees (USD)", "order": 6},
    ],
}
register(
    "report_client_positions",
    lambda t: Books(t).report(_OPEN_FEES),
    """SELECT CustomerId, Symbol, PositionPeriod, KycStatus, CAST(PeriodEndValuationUSD AS DOUBLE) AS PeriodEndValuationUSD
            , CAST(PendingFeesUSD AS DOUBLE) AS PendingFeesUSD FROM Spine WHERE KycStatus <> 'SUSPENDED'""",
)



def _labels(t: SemanticTables) -> DataFrame:
    """Label and note of every report column, as its comment says, and how many of its values are not null."""
    rows = stored(t).report(reports.CUSTODY_MONTHLY)
    counts = rows.agg(*[F.count(F.col(name)).alias(name) for name in rows.columns])
    entries = [F.struct(F.lit(f.name).alias("Name"), F.lit(f.metadata["comment"]).alias("Comment"), F.col(f.name).alias("Filled")) for f in rows.schema]
    return counts.select(F.inline(F.array(*entries)))


# What a reader of the report sees above its columns.
_LABELS = {
    "PeriodLabel": "Statement Period", "CustomerName": "Client Name", "Symbol": "Asset", "AssetName": "Asset Name",
    "PeriodEndQuantity": "Quantity Held", "PeriodEndPriceUSD": "Price (USD)", "PeriodEndValuationUSD": "Market Value (USD)",
    "QuantityChangePeriodOverPeriod": "Quantity Change (MoM)", "ValuationChangePeriodOverPeriodUSD": "Value Change (MoM, USD)",
    "ValuationChangePctPeriodOverPeriod": "Value Change (MoM, %)", "SettledNetRewards": "Settled Staking Rewards (USD)",
    "NetPendingRewards": "Pending Rewards (USD)", "TotalPositionValueWithNetpenUSD": "Total Economic Exposure (USD)",
    "TotalFeesUSD": "Fees Charged (USD)", "CustodianLedgerRef": "Custodian Reference",
    "StatementId": "Statement ID. Unique ID for this statement row — used as delivery idempotency key",
}
register(
    "report_labels",
    _labels,
    " UNION ALL ".join(f"SELECT '{name}' AS Name, '{text}' AS Comment, COUNT({name}) AS Filled FROM ({_REPORT_SQL})" for name, text in _LABELS.items()),
)


def _stamps(t: SemanticTables) -> DataFrame:
    """Run times and issuer of a run, on every layer that carries them."""
    books = Books(t, entity="Some Bank", run_ts=_run_ts(), keep=materialise)
    layers = {
        "ClientPeriodPositions": (books.client_positions, "_BuiltAt", F.lit("-")),
        "ReconciliationSummary": (books.reconciliation, "ReconciliationRunAt", F.col("Entity")),
        "LedgerBalanceTieOut": (books.tie_out, "ReconRunAt", F.lit("-")),
        "MonthlyCustodyStatement": (books.monthly_statement, "StatementGeneratedAt", F.col("IssuingEntity")),
    }
    parts = [
        df.groupBy(F.lit(name).alias("Layer"), F.col(stamp).cast("string").alias("RunAt"), entity.alias("Entity")).agg(F.count("*").alias("Rows"))
        for name, (df, stamp, entity) in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


register(
    "run_stamps",
    _stamps,
    " UNION ALL ".join(
        f"SELECT '{name}' AS Layer, '{RUN_AT:%Y-%m-%d %H:%M:%S}' AS RunAt, '{entity}' AS Entity, COUNT(*) AS Rows FROM {view}"
        for name, entity, view in (
            ("ClientPeriodPositions", "-", "Spine"), ("ReconciliationSummary", "Some Bank", "Recon"), ("LedgerBalanceTieOut", "-", "Tie"),
            ("MonthlyCustodyStatement", "Some Bank", "Stmt"),
        )
    ),
)

_CLIENT_FILTERS = {
    "equals": ({"field": "RiskTier", "operator": "equals", "value": "tier_1"}, "RiskTier = 'tier_1'"),
    "equals_flag": ({"field": "IsActive", "operator": "equals", "value": False}, "NOT IsActive"),
    "in": ({"field": "KycStatus", "operator": "in", "values": ["PENDING", "SUSPENDED"]}, "KycStatus IN ('PENDING', 'SUSPENDED')"),
    "not_equals": ({"field": "CustomerType", "operator": "not_equals", "value": "HEDGE_FUND"}, "CustomerType <> 'HEDGE_FUND'"),
}
for _name, (_rule, _sql) in _CLIENT_FILTERS.items():
    register(
        f"report_filter_{_name}",
        lambda t, rule=_rule: reports.filter_clients(t.Customers, [rule]),
        f"SELECT * FROM Customers WHERE {_sql}",
    )
_COMBINED = [_CLIENT_FILTERS[name] for name in ("equals", "in", "not_equals")]
register(
    "report_filter_combined",
    lambda t: reports.filter_clients(t.Customers, [rule for rule, _ in _COMBINED]),
    "SELECT * FROM Customers WHERE " + " AND ".join(sql for _, sql in _COMBINED),
)
register(
    "report_conditional_column",
    lambda t: reports.project(
        t.Customers,
        [
            {"name": "CustomerName", "include_if": "IsActive = true"},
            {"name": "CustomerId", "order": 1},
            {"name": "RiskTier", "order": 2, "label": "Risk tier"},
        ],
    ),
    "SELECT CustomerId, RiskTier, CASE WHEN IsActive THEN CustomerName END AS CustomerName FROM Customers",
)

# Data-quality tests. Where the test data has no violation, Spark derives some from it.
_SHORTED = "Quantity - 25"
register(
    "quality_fee_amounts_positive",
    lambda t: quality.fee_amounts_positive(t.FeeEvents),
    """SELECT ID, CustomerId, AssetId, FeeType, BasisPoints, CAST(FeeAmountUSD AS DOUBLE) AS FeeAmountUSD
            , CAST(AumAtBilling AS DOUBLE) AS AumAtBilling, FeePeriodStart
            , CASE WHEN FeeAmountUSD <= 0 THEN 'ZERO_OR_NEGATIVE_FEE' WHEN BasisPoints <= 0 THEN 'INVALID_BASIS_POINTS'
                   ELSE 'ZERO_OR_NEGATIVE_AUM' END AS failure_reason
         FROM FeeEvents WHERE LEAST(FeeAmountUSD, BasisPoints, AumAtBilling) <= 0""",
)


def _raw_line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(line.cast("string").alias("ID"))


QUERIES["quality_no_duplicate_events"] = lambda spark, sf_dir: quality.no_duplicate_events(_raw_line_ids(spark, sf_dir))
ORACLES["quality_no_duplicate_events"] = """
    SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS ID, COUNT(*) AS duplicate_count
         , 'DUPLICATE_EVENT_ID' AS failure_reason FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1"""
register(
    "quality_no_negative_balances",
    lambda t: quality.no_negative_balances(t.CustodyPositions.withColumn("Quantity", F.expr(_SHORTED))),
    f"""SELECT ID, CustomerId, AssetId, CAST({_SHORTED} AS DOUBLE) AS Quantity, CAST(PriceUSD AS DOUBLE) AS PriceUSD
            , CAST(ValuationUSD AS DOUBLE) AS ValuationUSD, PositionDate, 'NEGATIVE_BALANCE' AS failure_reason
         FROM CustodyPositions WHERE Quantity < 25""",
)
_REVERSED = "CASE WHEN RewardState = 'pending' THEN 40000 - NetAmount ELSE NetAmount END"


def _reversed_rewards(t: SemanticTables) -> DataFrame:
    events = t.StakingEvents.withColumn("NetAmount", F.expr(_REVERSED).cast("decimal(28,4)"))
    return Books(replace(t, StakingEvents=events)).staking_rewards


register(
    "quality_settled_within_earned",
    lambda t: quality.settled_within_earned(_reversed_rewards(t)),
    f"""SELECT CustomerId, AssetId, RewardPeriod, CAST(s AS DOUBLE) AS SettledNetRewards
            , CAST(s + p AS DOUBLE) AS TotalNetRewardsAllStates, CAST(p AS DOUBLE) AS NetPendingRewards
            , CASE WHEN s > s + p THEN 'SETTLED_EXCEEDS_EARNED' ELSE 'NEGATIVE_PENDING_REWARDS' END AS failure_reason
         FROM (SELECT CustomerId, AssetId, {oracle._month('EarnDate')} AS RewardPeriod
                    , COALESCE(SUM(NetAmount) FILTER (RewardState = 'settled'), 0) AS s
                    , COALESCE(SUM(40000 - NetAmount) FILTER (RewardState = 'pending'), 0) AS p
                 FROM StakingEvents GROUP BY 1, 2, 3) WHERE p < 0""",
)
# Cancelled events blown up so far that their text form needs an exponent.
_BLOWN_UP = "CASE WHEN Status = 'cancelled' THEN CAST(GrossAmount AS DOUBLE) * 1e20 ELSE CAST(GrossAmount AS DOUBLE) END"
register(
    "quality_no_scientific_notation",
    lambda t: quality.no_scientific_notation(
        t.FinancialEvents.select(F.expr(_BLOWN_UP).alias("Amount")), "Amount"
    ),
    f"""SELECT {_BLOWN_UP} AS Amount, 'SCIENTIFIC_NOTATION_IN_AMOUNT' AS failure_reason
         FROM FinancialEvents WHERE GrossAmount <> 0 AND Status = 'cancelled'""",
)
register(
    "quality_take_rate_in_bounds",
    lambda t: quality.take_rate_in_bounds(Books(t).staking_rewards, min_pct=0.02, max_pct=0.08),
    """SELECT CustomerId, AssetId, RewardPeriod, FeeTakeRatePct AS fee_take_rate_pct
            , 'FEE_RATE_OUT_OF_BOUNDS' AS failure_reason
         FROM Rew WHERE NOT FeeTakeRatePct BETWEEN 0.02 AND 0.08""",
)
register(
    "quality_all_records_reconciled",
    lambda t: quality.all_records_reconciled(Books(t).reconciliation, clean="Reconciled"),
    """SELECT CustomerId, Symbol, PositionPeriod, ReconciliationStatus
            , 'NOT_RECONCILED_AT_PERIOD_CLOSE' AS failure_reason FROM Recon WHERE ReconciliationStatus <> 'Reconciled'""",
)

# Source contracts.
register(
    "contract_not_null",
    lambda t: contracts.not_null(t.FinancialEvents, "SettlementDate"),
    f"SELECT {oracle._doubles(*oracle.AMOUNTS['FinancialEvents'])} FROM FinancialEvents WHERE SettlementDate IS NULL",
)
QUERIES["contract_unique"] = lambda spark, sf_dir: contracts.unique(_raw_line_ids(spark, sf_dir), "ID")
ORACLES["contract_unique"] = """
    SELECT ID, row_count FROM (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS ID, COUNT(*) AS row_count
      FROM lineitem GROUP BY 1) WHERE row_count > 1"""
# Positions of large quantities refer to an asset that no reference knows.
_ORPHANED = "CASE WHEN Quantity > 45 THEN AssetId || '_OLD' ELSE AssetId END"
register(
    "contract_relationship",
    lambda t: contracts.relationship(
        t.CustodyPositions.withColumn("AssetId", F.expr(_ORPHANED)), "AssetId", t.ReferenceAssets, "AssetId"
    ),
    f"""SELECT {oracle._doubles(*oracle.AMOUNTS['CustodyPositions'])}
          FROM (SELECT * REPLACE ({_ORPHANED} AS AssetId) FROM CustodyPositions)
         WHERE AssetId NOT IN (SELECT AssetId FROM ReferenceAssets)""",
)
register(
    "contract_accepted_range",
    lambda t: contracts.at_least(t.CustodyPositions.select("ID", F.expr(_SHORTED).alias("Quantity")), "Quantity"),
    f"SELECT ID, CAST({_SHORTED} AS DOUBLE) AS Quantity FROM CustodyPositions WHERE Quantity < 25",
)
for _name, (_table, _value, _accepted) in {
    "reward_state": (
        "StakingEvents", "CASE WHEN DistributeDate IS NULL THEN RewardState ELSE 'distributed' END", K.REWARD_STATES,
    ),
    "fee_type": ("FeeEvents", "FeeType", K.FEE_TYPES),
    "billing_status": ("FeeEvents", "BillingStatus", K.BILLING_STATUSES),
    "kyc_status": ("Customers", "CASE WHEN IsActive THEN KycStatus ELSE 'CLOSED' END", K.KYC_STATUSES),
}.items():
    _key = "CustomerId" if _table == "Customers" else "ID"
    register(
        f"contract_accepted_{_name}",
        lambda t, table=_table, key=_key, value=_value, accepted=_accepted: contracts.accepted_values(
            t[table].select(key, F.expr(value).alias("Value")), "Value", accepted
        ),
        f"SELECT {_key}, {_value} AS Value FROM {_table} WHERE {_value} NOT IN {_accepted}",
    )
register(
    "contract_period_end_reference",
    lambda t: contracts.period_end_reference_present(Books(t).balances),
    f"SELECT {oracle._doubles(*oracle.BALANCE_AMOUNTS)} FROM Bal WHERE CustodianLedgerRef IS NULL",
)
register(
    "contract_valuation_consistent",
    lambda t: contracts.valuation_consistent(t.CustodyPositions),
    f"""SELECT {oracle._doubles(*oracle.AMOUNTS['CustodyPositions'])} FROM CustodyPositions
         WHERE ABS(ValuationUSD - Quantity * PriceUSD) > 0.01""",
)
register(
    "contract_net_reward_consistent",
    lambda t: contracts.net_reward_consistent(
        t.StakingEvents.select("ID", "GrossAmount", F.round("FeeAmount", 2).alias("FeeAmount"), "NetAmount")
    ),
    """SELECT ID, CAST(GrossAmount AS DOUBLE) AS GrossAmount, CAST(ROUND(FeeAmount, 2) AS DOUBLE) AS FeeAmount
            , CAST(NetAmount AS DOUBLE) AS NetAmount
         FROM StakingEvents WHERE ABS(GrossAmount - ROUND(FeeAmount, 2) - NetAmount) > 0.0001""",
)
register(
    "contract_invoice_reference",
    lambda t: contracts.invoice_reference_present(t.FeeEvents, invoiced="accrued"),
    f"""SELECT {oracle._doubles(*oracle.AMOUNTS['FeeEvents'])} FROM FeeEvents
         WHERE BillingStatus = 'accrued' AND InvoiceReference IS NULL""",
)
register(
    "contract_grain",
    lambda t: contracts.unique(t.CustodyPositions, ("CustomerId", "AssetId", "PositionDate")),
    """SELECT CustomerId, AssetId, PositionDate, COUNT(*) AS row_count FROM CustodyPositions
        GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
)


def _freshness(t: SemanticTables) -> DataFrame:
    rows = contracts.freshness(t.CustodyPositions, "CreatedAt", _run_ts(), warn_hours=12, error_hours=24 * 365)
    return rows.withColumn("LatestLoad", F.col("LatestLoad").cast("string"))


def _run_ts():
    return F.lit(RUN_AT.isoformat(sep=" ")).cast("timestamp")


register(
    "contract_freshness",
    _freshness,
    f"""SELECT strftime(m, '%Y-%m-%d %H:%M:%S') AS LatestLoad
            , date_diff('second', m, TIMESTAMP '{RUN_AT}') // 3600 AS AgeHours
            , CASE WHEN date_diff('second', m, TIMESTAMP '{RUN_AT}') > 24 * 365 * 3600 THEN 'error'
                   WHEN date_diff('second', m, TIMESTAMP '{RUN_AT}') > 12 * 3600 THEN 'warn' ELSE 'pass' END AS Status
         FROM (SELECT MAX(CreatedAt) AS m FROM CustodyPositions)""",
)


def _later_log(t: SemanticTables) -> DataFrame:
    """A later state of the event log in which cancelled rows vanished and pending ones were edited."""
    kept = t.FinancialEvents.filter("Status <> 'cancelled'")
    return kept.withColumn("Status", F.regexp_replace("Status", "pending", "settled"))


register(
    "contract_append_only",
    lambda t: contracts.append_only(t.FinancialEvents, _later_log(t)),
    f"""SELECT {oracle._doubles(*oracle.AMOUNTS['FinancialEvents'])} FROM FinancialEvents
         WHERE Status IN ('pending', 'cancelled')""",
)


def _snapshots(t: SemanticTables) -> DataFrame:
    # Positions whose number ends in 3 reached the platform eight weeks late.
    late = F.when(F.col("ID").endswith("3"), F.date_add("PositionDate", 56)).otherwise(F.col("PositionDate"))
    loaded = t.CustodyPositions.withColumn("LoadedAt", late.cast("timestamp"))
    rows = contracts.snapshot_on_time(loaded, "LoadedAt")
    return rows.withColumns({name: F.col(name).cast("string") for name in ("LoadedAt", "Deadline")})


register(
    "contract_snapshot_on_time",
    _snapshots,
    """SELECT PositionPeriod, strftime(l, '%Y-%m-%d %H:%M:%S') AS LoadedAt, strftime(d, '%Y-%m-%d %H:%M:%S') AS Deadline
            , CASE WHEN l > d THEN 'LATE' ELSE 'ON_TIME' END AS Status
         FROM (SELECT PositionPeriod, PositionPeriod + INTERVAL 1 MONTH + INTERVAL 4 HOUR AS d
                    , MAX(CASE WHEN ID LIKE '%3' THEN PositionDate + 56 ELSE PositionDate END)::TIMESTAMP AS l
                 FROM Pos GROUP BY 1, 2)""",
)
_HASHED_UNLESS_PENDING = "CASE WHEN KycStatus = 'PENDING' THEN CustomerId ELSE {} END"
register(
    "contract_customer_ids_hashed",
    lambda t: contracts.customer_ids_hashed(
        t.Customers.select("CustomerName", F.expr(_HASHED_UNLESS_PENDING.format("sha2(CustomerId, 256)")).alias("CustomerId"))
    ),
    "SELECT CustomerName, CustomerId FROM Customers WHERE KycStatus = 'PENDING'",
)


def _contract_report(t: SemanticTables, name: str) -> DataFrame:
    if name != "FinancialEvents":
        return contracts.contract_report(t, name, _run_ts())
    # A later state of the event log, checked against the earlier one.
    return contracts.contract_report({name: _later_log(t)}, name, _run_ts(), previous=t[name])


for _table in SCHEMAS:
    register(
        f"contract_report_{snake(_table)}",
        lambda t, name=_table: _contract_report(t, name),
        oracle.contract_rows(_table, RUN_AT),
    )
register(
    "contract_append_only_digest",
    lambda t: contracts.append_only_by_digest(t.FinancialEvents, _later_log(t)),
    f"""SELECT {oracle._doubles(*oracle.AMOUNTS['FinancialEvents'])} FROM FinancialEvents
         WHERE Status IN ('pending', 'cancelled')""",
)
# One column is missing, one is text instead of a flag, and one holds nulls.
register(
    "contract_report_mistyped",
    lambda t: contracts.contract_report(
        {
            "Customers": t.Customers.drop("KycStatus").withColumns(
                {"IsActive": F.col("IsActive").cast("string"), "CustomerName": F.when(F.col("RiskTier") != "tier_1", F.col("CustomerName"))}
            )
        },
        "Customers",
    ),
    """SELECT 'Customers' AS TableName, c AS CheckName, n AS ColumnName, TRUE AS Critical, f AS FailingCount
            , CASE WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END AS Status
         FROM (SELECT 'column_type' AS c, 'CustomerId' AS n, 0 AS f UNION ALL SELECT 'column_type', 'CustomerName', 0
               UNION ALL SELECT 'column_type', 'KycStatus', 1 UNION ALL SELECT 'column_type', 'IsActive', 1
               UNION ALL SELECT 'not_null', 'CustomerId', 0
               UNION ALL SELECT 'not_null', 'CustomerName', (SELECT COUNT(*) FROM Customers WHERE RiskTier = 'tier_1')
               UNION ALL SELECT 'unique', 'CustomerId', 0)""",
)


def _freshness_of_files(t: SemanticTables) -> DataFrame:
    """All six tables, just written, as they look 60 hours later: the load time is that of the files."""
    spark = spark_of(t)
    path = scratch_path(spark, "fresh")
    tables.store_by_month(t, path)
    later = F.current_timestamp() + F.expr("INTERVAL 60 HOURS")
    parts = []
    for name in SCHEMAS:
        loaded = tables.with_load_time(spark.read.parquet(f"{path}/{name}"))
        status = contracts.contract_freshness(loaded, name, tables.LOADED_AT, later)
        parts.append(status.select(F.lit(name).alias("TableName"), (F.col("LatestLoad") < F.current_timestamp()).alias("LoadedBefore"), "AgeHours", "Status"))
    return reduce(DataFrame.unionByName, parts)


register(
    "contract_freshness_of_files",
    _freshness_of_files,
    """SELECT * FROM (VALUES ('Customers', TRUE, CAST(60 AS BIGINT), 'warn'), ('ReferenceAssets', TRUE, 60, 'pass'), ('CustodyPositions', TRUE, 60, 'error')
         , ('StakingEvents', TRUE, 60, 'error'), ('FeeEvents', TRUE, 60, 'error'), ('FinancialEvents', TRUE, 60, 'error'))
         AS f(TableName, LoadedBefore, AgeHours, Status)""",
)


# Sinks: each writes below the shared folder and reads the result back.
def _stored_calcs(t: SemanticTables) -> DataFrame:
    spark = spark_of(t)
    path = scratch_path(spark, "fee-calcs")
    tables.store(Books(t).calc("FeeEvents"), path)
    return spark.read.parquet(path)


register("sink_table", _stored_calcs, f"SELECT ID, {oracle.calc_columns('FeeEvents')} FROM FeeEvents")


def _stored_by_month(t: SemanticTables) -> DataFrame:
    spark = spark_of(t)
    path = scratch_path(spark, "balances-by-month")
    tables.store(Books(t).balances, path, ["PositionPeriod"])
    stored = spark.read.parquet(path)
    return stored.select(*[c for c in stored.columns if c != "PositionPeriod"], F.col("PositionPeriod").cast("date"))


register("sink_partitioned_table", _stored_by_month, _BALANCES_SQL)


def _view(t: SemanticTables) -> DataFrame:
    tables.as_view(Books(t).staking_rewards, "closebook_staking_rewards")
    return spark_of(t).sql("SELECT * FROM closebook_staking_rewards")


register("sink_view", _view, f"SELECT {oracle._doubles(*oracle.REWARD_SUMS)} FROM Rew")


def _read_statement_csv(spark: SparkSession, path: str, like: DataFrame, **options: bool) -> DataFrame:
    return spark.read.schema(like.schema).options(header=True, enforceSchema=False, mode="FAILFAST", **options).csv(path)


FILES = 100  # small files that a task reads; it holds the buffers of each until it ends


def _in_fewer_tasks(rows: DataFrame, folder: str) -> DataFrame:
    """The rows of a folder of very many small files, or of folders with one each, which Spark would else read with a task for every few of them."""
    fs, path = hadoop_path(rows.sparkSession, folder)
    return rows.coalesce(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(fs.listStatus(path)) // FILES))


def _exported(t: SemanticTables) -> DataFrame:
    spark = spark_of(t)
    rows = Books(t).monthly_statement.drop("StatementGeneratedAt")
    folder = delivery.export_statements(rows, scratch_path(spark, "statements"), RUN_AT.date().replace(day=1), statement.DERIVED)
    return _read_statement_csv(spark, folder, rows)


register("sink_statement_csv", _exported, _STATEMENT_SQL)


def _exported_per_client(t: SemanticTables) -> DataFrame:
    """The statements of one closed month, a folder per client."""
    spark = spark_of(t)
    rows = Books(t).monthly_statement.drop("StatementGeneratedAt")
    folder = delivery.export_per_client(rows, scratch_path(spark, "per-client"), CLOSED_MONTH)
    return _in_fewer_tasks(_read_statement_csv(spark, folder, rows, recursiveFileLookup=True), folder)


register("sink_statement_per_client", _exported_per_client, f"{_STATEMENT_SQL} WHERE PositionPeriod = DATE '{CLOSED_MONTH}'")


def _delivery_log(t: SemanticTables) -> DataFrame:
    """Half of the clients first, then everyone: each statement is logged once."""
    spark = spark_of(t)
    path = scratch_path(spark, "delivery-log")
    # Both runs read the same rows, and of the wide statement only these columns.
    rows = materialise(Books(t).monthly_statement.select("StatementId", "CustomerId", "PositionPeriod", "RiskTier"), "statements", COMPACT)
    delivery.record_deliveries(rows.filter("RiskTier <> 'tier_1'"), path, _run_ts())
    delivery.record_deliveries(rows, path, _run_ts())
    logged = delivery.read_log(rows, path).drop("Attempt", "EventId")
    return logged.withColumn("AttemptedAt", F.col("AttemptedAt").cast("string"))


register(
    "sink_delivery_log",
    _delivery_log,
    f"""SELECT DISTINCT StatementId, CustomerId, PositionPeriod, 'SENT' AS DeliveryStatus
            , '{RUN_AT:%Y-%m-%d %H:%M:%S}' AS AttemptedAt FROM Stmt""",
)


# Seed files: every table as a seed file, loaded from it.
def _as_seed(t: SemanticTables, table: str) -> DataFrame:
    """A semantic table in the columns of its seed file; what the table does not hold is empty."""
    rows = t[table]
    names = {seeds.semantic_name(table, column.name): column for column in seeds.SEEDS[seeds.SEED_OF_TABLE[table]]}
    wanted = []
    for name, column in names.items():
        value = F.col(name) if name in rows.columns else F.lit(None)
        if column.dataType == T.TimestampType():
            value = F.date_format(value.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        elif column.dataType == T.BooleanType():
            value = F.initcap(value.cast("string"))
        wanted.append(value.cast("string").alias(column.name))
    return rows.select(*wanted)


def _seed_round_trip(t: SemanticTables, table: str) -> DataFrame:
    path = scratch_path(spark_of(t), "seed")
    _as_seed(t, table).write.option("header", True).csv(path)
    loaded = seeds.load_seed(spark_of(t), seeds.SEED_OF_TABLE[table], path, scratch_path(spark_of(t), "rejects"))
    return seeds.to_semantic(loaded, table)


for _table in SCHEMAS:
    _amounts = oracle.AMOUNTS.get(_table)
    _columns = f"SELECT {oracle._doubles(*_amounts) if _amounts else '*'} FROM {_table}"
    if _table == "FinancialEvents":  # seed files hold whole seconds
        _columns = f"SELECT * REPLACE (date_trunc('second', EventTimestamp) AS EventTimestamp) FROM ({_columns})"
    register(f"seed_csv_{snake(_table)}", lambda t, table=_table: _seed_round_trip(t, table), _columns)


def _seed_rejects(t: SemanticTables) -> DataFrame:
    """Fee events with planted bad lines: a word for an amount, a date that does not exist, a field too many."""
    spark = spark_of(t)
    path, rejects = scratch_path(spark, "bad-seed"), scratch_path(spark, "rejects")
    rows = _as_seed(t, "FeeEvents").withColumn("key", F.substring("fee_id", 4, 20).cast("bigint"))
    rows = rows.withColumns({
        "fee_amount_usd": F.when(F.col("key") % 1000 == 7, "many").otherwise(F.col("fee_amount_usd")),
        "fee_period_end": F.when(F.col("key") % 1000 == 39, "1998-02-30").otherwise(F.col("fee_period_end")),
        "created_at": F.when(F.col("key") % 1000 == 70, "x,y").otherwise(F.lit("2001-12-01 06:00:00")),
    })
    columns = [name for name in rows.columns if name != "key"]
    lines = rows.select(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in columns]).alias("value"))
    lines.write.text(path)
    good = seeds.load_seed(spark, "raw_fee_events", path, rejects, max_rejects=1_000_000, header=False)
    kept = good.select(F.lit("kept").alias("Outcome"), F.col("fee_id").alias("Id"))
    bad = seeds.read_rejects(spark, rejects)
    return kept.union(bad.select("Reason", F.substring_index("Line", ",", 1)))


register("seed_rejects", _seed_rejects, None)
ORACLES["seed_rejects"] = """
    SELECT CASE o_orderkey % 1000 WHEN 7 THEN 'fee_amount_usd: not a number' WHEN 39 THEN 'fee_period_end: not a date'
                WHEN 70 THEN 'wrong number of fields' ELSE 'kept' END AS Outcome, 'FEE' || o_orderkey AS Id FROM orders"""


def clean_tables(t: SemanticTables) -> SemanticTables:
    """The test tables with every exception resolved, so that a close can succeed; all other rows and values are as given.

    Fees count as billed, and a month-end key without any fee gets one; open events are settled, missing ledger references are
    filled in, valuations that are off follow from quantity and price, and active clients are approved.
    """
    expected = F.expr("CAST(Quantity * PriceUSD AS DECIMAL(28,2))")
    positions = t.CustodyPositions.withColumns(
        {
            "CustodianLedgerRef": F.coalesce("CustodianLedgerRef", F.concat(F.lit("REF-"), F.col("ID"))),
            "ValuationUSD": F.when(F.col("ValuationUSD").isNull() | (F.abs(F.col("ValuationUSD") - expected) > 0.01), expected).otherwise(F.col("ValuationUSD")),
        }
    )
    keys = ["CustomerId", "AssetId", "FeePeriodStart"]
    held = positions.groupBy("CustomerId", "AssetId", F.trunc("PositionDate", "MM").alias("FeePeriodStart")).agg(F.min("ID").alias("first"))
    missing = held.join(t.FeeEvents.select(*keys), keys, "left_anti")
    extra = missing.select(
        F.concat(F.lit("FEE-"), F.col("first")).alias("ID"), "CustomerId", "AssetId", F.lit("custody").alias("FeeType"),
        F.lit(15).cast("bigint").alias("BasisPoints"), F.lit(100).cast("decimal(18,2)").alias("FeeAmountUSD"),
        F.lit(1000).cast("decimal(22,2)").alias("AumAtBilling"), "FeePeriodStart",
        F.last_day("FeePeriodStart").alias("FeePeriodEnd"), F.lit("billed").alias("BillingStatus"),
        F.concat(F.lit("INV-"), F.col("first")).alias("InvoiceReference"),
    )
    settled = F.when(F.col("Status") == "pending", "settled").otherwise(F.col("Status"))
    return replace(
        t,
        Customers=t.Customers.withColumn("KycStatus", F.when(F.col("IsActive"), "APPROVED").otherwise(F.col("KycStatus"))),
        CustodyPositions=positions,
        FeeEvents=t.FeeEvents.withColumn("BillingStatus", F.lit("billed")).unionByName(extra),
        FinancialEvents=t.FinancialEvents.withColumn("Status", settled),
    )


def _closed(t: SemanticTables) -> DataFrame:
    spark = spark_of(t)
    result = close_period(clean_tables(t), RUN_AT, scratch_path(spark, "close"), scratch_path(spark, "close-log"))
    # Only the columns are asked for, so nothing is counted for them.
    like = Books(clean_tables(SemanticTables(**{name: t[name].limit(0) for name in SCHEMAS}))).monthly_statement
    return _read_statement_csv(spark, result.exported_to, like).drop("StatementGeneratedAt")


register("close_and_export", _closed, None)
ORACLES["close_and_export"] = oracle.with_views(_STATEMENT_SQL, cleaned=True)

NEXT_MONTH = date(1998, 7, 1)


def _closed_by_month(t: SemanticTables) -> DataFrame:
    """Two months closed one after the other over tables stored by month; the books hold both."""
    spark = spark_of(t)
    stored, books = scratch_path(spark, "by-month"), scratch_path(spark, "books")
    tables.store_by_month(clean_tables(t), stored)
    for month in (CLOSED_MONTH, NEXT_MONTH):
        close_month(spark, stored, month, RUN_AT, books)
    rows = spark.read.parquet(f"{books}/MonthlyCustodyStatement").drop("StatementGeneratedAt")
    return rows.withColumn("PositionPeriod", F.col("PositionPeriod").cast("date"))


register("close_one_month", _closed_by_month, None)
ORACLES["close_one_month"] = oracle.with_views(
    f"{_STATEMENT_SQL} WHERE PositionPeriod IN (DATE '{CLOSED_MONTH}', DATE '{NEXT_MONTH}')", cleaned=True
)


def _report_files(t: SemanticTables) -> DataFrame:
    """The custody report of one month as files per client, read back with their entries in the manifest."""
    spark = spark_of(t)
    root = scratch_path(spark, "reports")
    source = reports.with_client_flags(Books(t).monthly_statement, t.Customers)
    manifest = delivery.deliver_report(reports.CUSTODY_MONTHLY, source, root, CLOSED_MONTH)
    folder = delivery.destination(reports.CUSTODY_MONTHLY, root, CLOSED_MONTH)
    like = reports.report(reports.CUSTODY_MONTHLY, source)
    lines = spark.read.schema(like.schema).options(header=True, enforceSchema=False, mode="FAILFAST", escape='"').csv(folder)
    lines = _in_fewer_tasks(lines.withColumn("File", F.element_at(F.split("_metadata.file_path", "/"), -1)), folder)
    return lines.join(manifest.select("File", "CustomerId", "Rows"), "File", "full")


register(
    "sink_report_per_client",
    _report_files,
    f"""SELECT * , 'custody_statement_' || CustomerId || '_{CLOSED_MONTH}.csv' AS File, COUNT(*) OVER (PARTITION BY CustomerId) AS Rows
          FROM (SELECT {oracle.report_columns()}, CustomerId FROM {_REPORT_SOURCE} WHERE KycStatus = 'APPROVED' AND IsActive
                   AND CustomerType IN ('INSTITUTIONAL', 'HEDGE_FUND', 'ASSET_MANAGER', 'PENSION_FUND')
                   AND PositionPeriod = DATE '{CLOSED_MONTH}')""",
)


def _delivery_retry(t: SemanticTables) -> DataFrame:
    """Attempts that fail, are repeated, and are confirmed by receipts; every run happens twice."""
    spark = spark_of(t)
    path = scratch_path(spark, "delivery-retry")
    rows = materialise(
        Books(t).monthly_statement.select("StatementId", "CustomerId", "PositionPeriod", "RiskTier", "IsStakeable", "CustomerType"), "statements", COMPACT
    )
    first = rows.select("StatementId", (F.col("RiskTier") != "tier_1").alias("Delivered"))
    second = rows.select("StatementId", (~F.col("IsStakeable")).alias("Delivered"))
    received = F.lit("2001-11-30 00:00:00").cast("timestamp")
    receipts = rows.filter("CustomerType = 'INSTITUTIONAL'").select("StatementId", received.alias("ReceivedAt"))
    for hours, outcomes in ((0, first), (24, second)):
        for _ in range(2):
            delivery.record_deliveries(rows, path, _run_ts() + F.make_interval(hours=F.lit(hours)), outcomes=outcomes)
            delivery.confirm_deliveries(receipts, path)
    state = delivery.current_state(delivery.read_log(rows, path))
    return state.withColumn("AttemptedAt", F.col("AttemptedAt").cast("string"))


register(
    "sink_delivery_retry",
    _delivery_retry,
    f"""SELECT StatementId, CustomerId, PositionPeriod, Attempt, Attempt + CAST(DeliveryStatus = 'CONFIRMED' AS BIGINT) AS Events, DeliveryStatus
            , CASE Attempt WHEN 1 THEN '{RUN_AT:%Y-%m-%d %H:%M:%S}' ELSE '2001-12-02 06:00:00' END AS AttemptedAt
          FROM (SELECT DISTINCT StatementId, CustomerId, PositionPeriod, CASE RiskTier WHEN 'tier_1' THEN 2 ELSE 1 END AS Attempt
                     , CASE WHEN RiskTier = 'tier_1' AND IsStakeable THEN 'FAILED' WHEN CustomerType = 'INSTITUTIONAL' THEN 'CONFIRMED'
                            ELSE 'SENT' END AS DeliveryStatus FROM Stmt)""",
)
