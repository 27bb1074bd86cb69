"""SQL counterparts of the registered queries, written independently for DuckDB.

Every statement starts from the given tables. Amounts are compared as DOUBLE; run timestamps are left
out. Lists and samples are sorted.
"""

from __future__ import annotations

import re

from checks.fixture import ASSET_IDS, CLIENT_TYPES, OTHER_CLIENT_TYPE
from closebook import constants as K
from closebook.operators.reports import CUSTODY_MONTHLY

_CLIENT_TYPE = (
    "CASE c_mktsegment "
    + " ".join(f"WHEN '{segment}' THEN '{name}'" for segment, name in CLIENT_TYPES.items())
    + f" ELSE '{OTHER_CLIENT_TYPE}' END"
)


def _asset(number: str) -> str:
    names = ", ".join(f"'{key}'" for key in ASSET_IDS)
    return f"([{names}])[CAST(({number}) % 10 AS INT) + 1]"


# The semantic tables.
TABLES = {
    "ReferenceAssets": f"""
        SELECT {_asset('d')} AS AssetId, split_part({_asset('d')}, '_', 2) AS Symbol, name AS AssetName
             , CASE WHEN d IN (8, 9) THEN 'stablecoin' WHEN d = 0 THEN 'custody_only' ELSE 'staking' END AS AssetType
             , protocol AS Protocol, d BETWEEN 1 AND 7 AS IsStakeable
             , CASE WHEN d BETWEEN 1 AND 7 THEN CAST(GREATEST(power(d - 2, 2) + size - 50, 0) AS BIGINT) ELSE 0 END AS UnbondingDays
          FROM (SELECT p_partkey % 10 AS d, MIN(p_name) AS name, MIN(p_brand) AS protocol, MAX(p_size) AS size FROM part GROUP BY 1)""",
    "Customers": f"""
        SELECT 'CUST' || c_custkey AS CustomerId, c_name AS CustomerName, {_CLIENT_TYPE} AS CustomerType
             , n_name AS Jurisdiction
             , CASE c_custkey % 20 WHEN 7 THEN 'PENDING' WHEN 13 THEN 'SUSPENDED' ELSE 'APPROVED' END AS KycStatus
             , CASE WHEN c_acctbal >= 6000 THEN 'tier_1' WHEN c_acctbal >= 2000 THEN 'tier_2' ELSE 'tier_3' END AS RiskTier
             , c_custkey % 37 <> 0 AS IsActive
          FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "Lines": """
        SELECT l_orderkey AS okey, l_linenumber AS lno, l_orderkey * 10 + l_linenumber AS line
             , MAX(l_partkey) AS partkey, MAX(l_quantity) AS qty, MAX(l_extendedprice) AS ext, MAX(l_discount) AS disc
             , MAX(l_shipdate) AS ship, MAX(l_returnflag) AS rf, MAX(l_linestatus) AS ls
             , ANY_VALUE(o_custkey) AS custkey, ANY_VALUE(o_orderdate) AS odate
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
    "CustodyPositions": f"""
        SELECT 'POS' || line AS ID, 'CUST' || custkey AS CustomerId, {_asset('partkey')} AS AssetId
             , CAST(ship AS DATE) AS PositionDate, CAST(qty AS DECIMAL(18,2)) AS Quantity
             , CAST(p_retailprice AS DECIMAL(18,2)) AS PriceUSD
             , CAST(CAST(qty AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2))
                    + CASE lno WHEN 7 THEN 5 WHEN 6 THEN NULL ELSE 0 END AS DECIMAL(28,2)) AS ValuationUSD
             , CASE WHEN rf = 'R' AND lno = 1 THEN NULL ELSE 'REF-' || okey END AS CustodianLedgerRef
             , odate AS CreatedAt
          FROM Lines JOIN part ON p_partkey = partkey""",
    "StakingEvents": f"""
        SELECT 'STAKE' || line AS ID, 'CUST' || custkey AS CustomerId, a.AssetId
             , CAST(ext AS DECIMAL(18,2)) AS GrossAmount
             , CAST(CAST(ext AS DECIMAL(18,2)) * CAST(disc AS DECIMAL(4,2)) AS DECIMAL(28,4)) AS FeeAmount
             , CAST(CAST(ext AS DECIMAL(18,2)) * (1 - CAST(disc AS DECIMAL(4,2))) AS DECIMAL(28,4)) AS NetAmount
             , CAST(odate AS DATE) AS EarnDate
             , CASE ls WHEN 'F' THEN CAST(odate AS DATE) + CAST(a.UnbondingDays AS INT) END AS SettleDate
             , CASE WHEN ls = 'F' AND rf = 'A' THEN CAST(odate AS DATE) + CAST(a.UnbondingDays AS INT) + 1 END AS DistributeDate
             , CASE ls WHEN 'F' THEN 'settled' ELSE 'pending' END AS RewardState
             , CASE rf WHEN 'R' THEN 'mev_reward' ELSE 'block_reward' END AS RewardType
          FROM Lines JOIN ReferenceAssets a ON a.AssetId = {_asset('partkey')} AND a.IsStakeable""",
    "FeeEvents": f"""
        SELECT 'FEE' || o_orderkey AS ID, 'CUST' || o_custkey AS CustomerId, {_asset('o_orderkey')} AS AssetId
             , (['custody', 'staking', 'premium_reporting_fee'])[CAST(o_orderkey % 3 AS INT) + 1] AS FeeType
             , CAST(CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE ([15, 100, 5])[CAST(o_orderkey % 3 AS INT) + 1] END AS BIGINT) AS BasisPoints
             , CAST(CASE WHEN o_orderkey % 83 = 0 THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS FeeAmountUSD
             , CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) * 100 END AS DECIMAL(22,2)) AS AumAtBilling
             , CAST(date_trunc('month', o_orderdate) AS DATE) AS FeePeriodStart
             , last_day(CAST(o_orderdate AS DATE)) AS FeePeriodEnd
             , CASE WHEN o_orderkey % 11 = 0 THEN 'accrued' WHEN o_orderkey % 53 = 0 THEN 'waived' ELSE 'billed' END AS BillingStatus
             , CASE WHEN o_orderkey % 11 <> 0 THEN 'INV-' || o_orderkey END AS InvoiceReference
          FROM orders""",
    "FinancialEvents": f"""
        SELECT 'FE' || event_id AS ID, 'CUST' || user_id AS CustomerId, {_asset('event_id // 7')} AS AssetId
             , event_type AS EventType, CAST(value AS DECIMAL(18,2)) AS GrossAmount
             , CAST(CAST(value AS DECIMAL(18,2)) * 0.9 AS DECIMAL(28,4)) AS NetAmount, ts AS EventTimestamp
             , make_date(CAST(1995 + event_id % 80 // 12 AS INT), CAST(event_id % 80 % 12 + 1 AS INT), 1) AS PeriodDate
             , CASE WHEN NOT (event_type = 'error' AND event_id % 5 = 0) THEN CAST(ts AS DATE) + CAST(event_id % 4 AS INT) END AS SettlementDate
             , CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'pending' WHEN event_id % 101 = 0 THEN 'cancelled' ELSE 'settled' END AS Status
             , CASE event_type WHEN 'click' THEN 'custody' WHEN 'view' THEN 'staking' ELSE 'stablecoin' END AS ProductLine
          FROM events""",
}
FACTS = ("CustodyPositions", "StakingEvents", "FeeEvents", "FinancialEvents")


def _month(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


def _quarter(column: str) -> str:
    return f"CAST(date_trunc('quarter', {column}) AS DATE)"


def _year(column: str) -> str:
    return f"CAST(date_part('year', {column}) AS BIGINT)"


def _days(start: str, end: str) -> str:
    return f"date_diff('day', {start}, {end})"


_RATE = "ROUND(CAST({0} AS DOUBLE) / CAST(NULLIF({1}, 0) AS DOUBLE), 9)"

# One expression per micro-calc.
CALCS = {
    "CustodyPositions": {
        "AssetClass": "CASE WHEN right(AssetId, 4) IN ('USDC', 'USDT') THEN 'Stablecoin' "
        "WHEN right(AssetId, 3) IN ('BTC', 'ETH', 'SOL') THEN 'Layer1' ELSE 'AltCoin' END",
        "DaysInPeriod": f"date_diff('day', {_month('PositionDate')}, {_month('PositionDate')} + INTERVAL 1 MONTH)",
        "IsPeriodEnd": "day(PositionDate + 1) = 1",
        "IsStablecoin": "right(AssetId, 4) IN ('USDC', 'USDT')",
        "PositionAgeMonths": "date_diff('month', CAST(CreatedAt AS DATE), PositionDate)",
        "PositionPeriod": _month("PositionDate"),
        "PositionQuarter": _quarter("PositionDate"),
        "PositionYear": _year("PositionDate"),
        "ValuationTier": "CASE WHEN ValuationUSD IS NULL OR ValuationUSD < 1000000 THEN 'Standard' "
        "WHEN ValuationUSD < 10000000 THEN 'Prime' ELSE 'Institutional' END",
        "ValuationUSDRounded": "CAST(ROUND(ValuationUSD, 2) AS DOUBLE)",
    },
    "FeeEvents": {
        "EffectiveRateBps": f"ROUND({_RATE.format('FeeAmountUSD', 'AumAtBilling')} * 10000, 5)",
        "FeeAmountUSDRounded": "CAST(ROUND(FeeAmountUSD, 2) AS DOUBLE)",
        "FeePeriod": _month("FeePeriodStart"),
        "FeePeriodDays": _days("FeePeriodStart", "FeePeriodEnd"),
        "FeeQuarter": _quarter("FeePeriodStart"),
        "FeeYear": _year("FeePeriodStart"),
        "IsAccruedNotBilled": "BillingStatus ILIKE 'accrued'",
        "IsCustodyFee": "FeeType ILIKE 'custody'",
        "IsFullyBilled": "BillingStatus ILIKE 'billed'",
        "IsWaived": "BillingStatus ILIKE 'waived'",
    },
    "FinancialEvents": {
        "EventPeriod": _month("PeriodDate"),
        "EventQuarter": _quarter("PeriodDate"),
        "EventYear": _year("PeriodDate"),
        "IsCustodyEvent": "ProductLine ILIKE 'custody'",
        "IsPending": "Status ILIKE 'pending'",
        "IsSameDaySettle": "CAST(EventTimestamp AS DATE) = SettlementDate",
        "IsSettledFinancial": "Status ILIKE 'settled'",
        "IsStakingEvent": "ProductLine ILIKE 'staking'",
        "NetAmountRoundedFinancial": "CAST(ROUND(NetAmount, 2) AS DOUBLE)",
        "SettlementLagDays": _days("CAST(EventTimestamp AS DATE)", "SettlementDate"),
    },
    "StakingEvents": {
        "EarnPeriod": _month("EarnDate"),
        "EarnQuarter": _quarter("EarnDate"),
        "EarnYear": _year("EarnDate"),
        "IsBelowMinDistribution": "NetAmount < CAST(0.0001 AS DECIMAL(10,4))",
        "IsDistributed": "DistributeDate IS NOT NULL",
        "IsSettledStaking": "RewardState ILIKE 'settled'",
        "NetAmountRoundedStaking": "CAST(ROUND(NetAmount, 8) AS DOUBLE)",
        "SettlePeriod": _month("SettleDate"),
        "UnbondingCategory": "(SELECT CASE WHEN r.UnbondingDays = 0 THEN 'Immediate' WHEN r.UnbondingDays <= 3 THEN 'ShortTail' "
        "WHEN r.UnbondingDays <= 21 THEN 'MediumTail' ELSE 'LongTail' END "
        "FROM ReferenceAssets r WHERE r.AssetId = StakingEvents.AssetId)",
        "UnbondingDays": _days("EarnDate", "SettleDate"),
    },
}

AMOUNTS = {
    "CustodyPositions": ("Quantity", "PriceUSD", "ValuationUSD"),
    "StakingEvents": ("GrossAmount", "FeeAmount", "NetAmount"),
    "FeeEvents": ("FeeAmountUSD", "AumAtBilling"),
    "FinancialEvents": ("GrossAmount", "NetAmount"),
}


def _doubles(*columns: str) -> str:
    """``*`` with the given columns cast for comparison."""
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + ")"


# Business layers, in dependency order.
VIEWS = {
    "Pos": f"SELECT *, {_month('PositionDate')} AS PositionPeriod FROM CustodyPositions",
    "Bal": """
        SELECT CustomerId, AssetId, PositionPeriod, PositionDate AS PeriodEndDate, Quantity AS PeriodEndQuantity
             , PriceUSD AS PeriodEndPriceUSD, ValuationUSD AS PeriodEndValuationUSD, CustodianLedgerRef
          FROM Pos p
         WHERE PositionDate = (SELECT MAX(q.PositionDate) FROM Pos q WHERE q.CustomerId = p.CustomerId
                                  AND q.AssetId = p.AssetId AND q.PositionPeriod = p.PositionPeriod)""",
    "Rew": f"""
        SELECT CustomerId, AssetId, {_month('EarnDate')} AS RewardPeriod
             , {CALCS['StakingEvents']['UnbondingCategory']} AS UnbondingCategory
             , COALESCE(SUM(NetAmount) FILTER (RewardState = 'settled'), 0) AS SettledNetRewards
             , COALESCE(SUM(GrossAmount) FILTER (RewardState = 'settled'), 0) AS SettledGrossRewards
             , COALESCE(SUM(FeeAmount) FILTER (RewardState = 'settled'), 0) AS SettledFees
             , COALESCE(SUM(NetAmount) FILTER (RewardState = 'pending'), 0) AS NetPendingRewards
             , COALESCE(SUM(GrossAmount) FILTER (RewardState = 'pending'), 0) AS GrossPendingRewards
             , SUM(NetAmount) AS TotalNetRewardsAllStates, SUM(GrossAmount) AS TotalGrossRewardsAllStates
             , SUM(FeeAmount) AS TotalFeesAllStates, COUNT(ID) AS TotalRewardEvents
             , {_RATE.format('SUM(FeeAmount)', 'SUM(GrossAmount)')} AS FeeTakeRatePct
          FROM StakingEvents GROUP BY 1, 2, 3, 4""",
    "Fee": f"""
        SELECT CustomerId, AssetId, {_month('FeePeriodStart')} AS FeePeriod, FeeType
             , SUM(FeeAmountUSD) AS TotalFeeAmountUSD, SUM(AumAtBilling) AS TotalAumBilled
             , AVG(BasisPoints) AS AvgBasisPoints, COUNT(ID) AS FeeEventCount
             , COALESCE(SUM(FeeAmountUSD) FILTER (BillingStatus = 'billed'), 0) AS BilledFeeAmountUSD
             , COALESCE(SUM(FeeAmountUSD) FILTER (BillingStatus <> 'billed'), 0) AS PendingFeeAmountUSD
             , BOOL_AND(BillingStatus = 'billed') AS AllFeesBilled
             , STRING_AGG(InvoiceReference, ', ' ORDER BY InvoiceReference) AS InvoiceReferences
          FROM FeeEvents GROUP BY 1, 2, 3, 4""",
    "FeeSum": """
        SELECT CustomerId, AssetId, FeePeriod, SUM(TotalFeeAmountUSD) AS TotalFeesUSD
             , SUM(BilledFeeAmountUSD) AS BilledFeesUSD, SUM(PendingFeeAmountUSD) AS PendingFeesUSD
             , BOOL_AND(AllFeesBilled) AS AllFeesBilled
             , STRING_AGG(InvoiceReferences, ' | ' ORDER BY InvoiceReferences) AS AllInvoiceReferences
          FROM Fee GROUP BY 1, 2, 3""",
    "Spine": """
        SELECT b.CustomerId, b.AssetId, b.PositionPeriod, c.CustomerName, c.CustomerType, c.Jurisdiction, c.RiskTier
             , c.KycStatus, a.Symbol, a.AssetName, a.AssetType, a.Protocol, a.IsStakeable, a.UnbondingDays
             , b.PeriodEndDate, b.PeriodEndQuantity, b.PeriodEndPriceUSD, b.PeriodEndValuationUSD, b.CustodianLedgerRef
             , r.SettledNetRewards, r.SettledGrossRewards, r.SettledFees AS StakingFeesSettled, r.NetPendingRewards
             , r.GrossPendingRewards, r.TotalNetRewardsAllStates, r.TotalGrossRewardsAllStates
             , r.TotalFeesAllStates AS TotalStakingFees, r.TotalRewardEvents, r.FeeTakeRatePct AS StakingFeeTakeRatePct
             , r.UnbondingCategory, f.TotalFeesUSD, f.BilledFeesUSD, f.PendingFeesUSD, f.AllFeesBilled
             , f.AllInvoiceReferences
             , CAST(b.PeriodEndValuationUSD AS DECIMAL(38,6)) + CAST(COALESCE(CAST(r.NetPendingRewards AS DECIMAL(18,4))
                 * CAST(b.PeriodEndPriceUSD AS DECIMAL(18,2)), 0) AS DECIMAL(38,6)) AS TotalPositionValueWithNetpenUSD
             , f.TotalFeesUSD IS NOT NULL AND b.PeriodEndValuationUSD IS NULL AS ReconFlagFeeWithoutBalance
          FROM Bal b LEFT JOIN Customers c USING (CustomerId) LEFT JOIN ReferenceAssets a USING (AssetId)
          LEFT JOIN Rew r ON r.CustomerId = b.CustomerId AND r.AssetId = b.AssetId AND r.RewardPeriod = b.PositionPeriod
          LEFT JOIN FeeSum f ON f.CustomerId = b.CustomerId AND f.AssetId = b.AssetId AND f.FeePeriod = b.PositionPeriod""",
    "Totals": f"""
        SELECT CustomerId, AssetId, {_month('PeriodDate')} AS EventPeriod, COUNT(ID) AS RawEventCount
             , SUM(GrossAmount) AS SumGrossFromEvents, SUM(NetAmount) AS SumNetFromEvents
             , COUNT(*) FILTER (Status = 'pending') AS PendingEventCount
          FROM FinancialEvents GROUP BY 1, 2, 3""",
    "Recon": f"""
        SELECT s.CustomerId, CustomerName, s.AssetId, Symbol, PositionPeriod, RiskTier
             , PeriodEndValuationUSD AS ReportedPositionUSD, CustodianLedgerRef AS CustodianSourceRef
             , TotalGrossRewardsAllStates AS ReportedGrossRewards, TotalStakingFees AS ReportedStakingFees
             , TotalNetRewardsAllStates AS ReportedNetRewards, NetPendingRewards, TotalFeesUSD AS ReportedFeesChargedUSD
             , BilledFeesUSD, AllFeesBilled, AllInvoiceReferences, RawEventCount, SumGrossFromEvents, SumNetFromEvents
             , PendingEventCount, '{K.DEFAULT_ENTITY}' AS Entity
             , CASE WHEN PeriodEndValuationUSD IS NULL AND RawEventCount > 0 THEN 'MissingPosition'
                    WHEN ReconFlagFeeWithoutBalance THEN 'FeeWithoutBalance'
                    WHEN PendingEventCount > 0 THEN 'HasPendingEvents'
                    WHEN AllFeesBilled THEN 'Reconciled' ELSE 'UnbilledFees' END AS ReconciliationStatus
          FROM Spine s LEFT JOIN Totals t
            ON t.CustomerId = s.CustomerId AND t.AssetId = s.AssetId AND t.EventPeriod = s.PositionPeriod""",
    "Tie": f"""
        SELECT CustomerId, AssetId, PositionPeriod, PeriodEndDate, Computed AS ComputedQuantity, Price AS PriceUSD
             , Valued AS ComputedValuationUSD, Restated AS RestatedValuationUSD, Valued - Restated AS VarianceUSD
             , Ref AS CustodianLedgerRef
             , CASE WHEN Ref IS NULL THEN 'UNCONFIRMED' WHEN ABS(Valued - Restated) > 0.01 THEN 'VARIANCE_DETECTED'
                    ELSE 'MATCHED' END AS LedgerStatus
             , CASE WHEN Ref IS NULL THEN '{K.UNCONFIRMED_TEXT}' WHEN ABS(Valued - Restated) > 0.01
                    THEN '{K.VARIANCE_TEXT}' || rtrim(rtrim(CAST(ABS(Valued - Restated) AS VARCHAR), '0'), '.')
               END AS ExceptionDetail
          FROM (SELECT CustomerId, AssetId, PositionPeriod, PeriodEndDate, PeriodEndQuantity AS Computed
                     , PeriodEndPriceUSD AS Price, PeriodEndValuationUSD AS Valued
                     , CAST(ROUND(PeriodEndQuantity * PeriodEndPriceUSD, 2) AS DECIMAL(28,2)) AS Restated
                     , CustodianLedgerRef AS Ref FROM Bal)""",
    "Stmt": f"""
        SELECT md5(c.CustomerId || '|' || c.AssetId || '|' || CAST(c.PositionPeriod AS VARCHAR)) AS StatementId
             , c.CustomerId, c.CustomerName, c.CustomerType, c.Jurisdiction, c.RiskTier, c.AssetId, c.Symbol, c.AssetName
             , c.AssetType, c.Protocol, c.IsStakeable, c.UnbondingDays, c.PositionPeriod
             , strftime(c.PositionPeriod, '%B %Y') AS PeriodLabel, c.PeriodEndDate, c.PeriodEndQuantity
             , c.PeriodEndPriceUSD, c.PeriodEndValuationUSD, c.CustodianLedgerRef
             , c.PeriodEndQuantity - COALESCE(p.PeriodEndQuantity, 0) AS QuantityChangePeriodOverPeriod
             , c.PeriodEndValuationUSD - COALESCE(p.PeriodEndValuationUSD, 0) AS ValuationChangePeriodOverPeriodUSD
             , ROUND(CAST({_RATE.format('(c.PeriodEndValuationUSD - p.PeriodEndValuationUSD)', 'p.PeriodEndValuationUSD')}
                 AS DECIMAL(28,9)) * 100, 4) AS ValuationChangePctPeriodOverPeriod
             , CASE WHEN c.IsStakeable THEN c.SettledNetRewards END AS SettledNetRewards
             , CASE WHEN c.IsStakeable THEN c.TotalNetRewardsAllStates END AS TotalNetRewardsAllStates
             , CASE WHEN c.IsStakeable THEN c.NetPendingRewards END AS NetPendingRewards
             , CASE WHEN c.IsStakeable THEN p.SettledNetRewards END AS PriorPeriodSettledNetRewards
             , c.TotalPositionValueWithNetpenUSD, c.TotalFeesUSD, c.BilledFeesUSD, c.AllFeesBilled
             , '{K.DEFAULT_ENTITY}' AS IssuingEntity
          FROM Spine c LEFT JOIN Spine p ON p.KycStatus = 'APPROVED' AND p.CustomerId = c.CustomerId
           AND p.AssetId = c.AssetId AND p.PositionPeriod = CAST(c.PositionPeriod - INTERVAL 1 MONTH AS DATE)
         WHERE c.KycStatus = 'APPROVED'""",
}

BALANCE_AMOUNTS = ("PeriodEndQuantity", "PeriodEndPriceUSD", "PeriodEndValuationUSD")
REWARD_SUMS = (
    "SettledNetRewards", "SettledGrossRewards", "SettledFees", "NetPendingRewards", "GrossPendingRewards",
    "TotalNetRewardsAllStates", "TotalGrossRewardsAllStates", "TotalFeesAllStates",
)
SPINE_AMOUNTS = (
    *BALANCE_AMOUNTS, "SettledNetRewards", "SettledGrossRewards", "StakingFeesSettled", "NetPendingRewards",
    "GrossPendingRewards", "TotalNetRewardsAllStates", "TotalGrossRewardsAllStates", "TotalStakingFees",
    "TotalFeesUSD", "BilledFeesUSD", "PendingFeesUSD", "TotalPositionValueWithNetpenUSD",
)
STATEMENT_AMOUNTS = (
    *BALANCE_AMOUNTS, "QuantityChangePeriodOverPeriod", "ValuationChangePeriodOverPeriodUSD",
    "ValuationChangePctPeriodOverPeriod", "SettledNetRewards", "TotalNetRewardsAllStates", "NetPendingRewards",
    "PriorPeriodSettledNetRewards", "TotalPositionValueWithNetpenUSD", "TotalFeesUSD", "BilledFeesUSD",
)
RECON_AMOUNTS = (
    "ReportedPositionUSD", "ReportedGrossRewards", "ReportedStakingFees", "ReportedNetRewards", "NetPendingRewards",
    "ReportedFeesChargedUSD", "BilledFeesUSD", "SumGrossFromEvents", "SumNetFromEvents",
)
TIE_AMOUNTS = ("ComputedQuantity", "PriceUSD", "ComputedValuationUSD", "RestatedValuationUSD", "VarianceUSD")

_ORDERED = {**TABLES, **VIEWS}


# The tables with every exception of the close resolved, see checks.queries.clean_tables.
CLEANED = {
    "Customers": "SELECT * REPLACE (CASE WHEN IsActive THEN 'APPROVED' ELSE KycStatus END AS KycStatus) FROM CustomersRaw",
    "CustodyPositions": """
        SELECT * REPLACE (COALESCE(CustodianLedgerRef, 'REF-' || ID) AS CustodianLedgerRef
             , CASE WHEN ValuationUSD IS NULL OR ABS(ValuationUSD - Quantity * PriceUSD) > 0.01
                    THEN CAST(Quantity * PriceUSD AS DECIMAL(28,2)) ELSE ValuationUSD END AS ValuationUSD) FROM CustodyPositionsRaw""",
    "FinancialEvents": "SELECT * REPLACE (CASE Status WHEN 'pending' THEN 'settled' ELSE Status END AS Status) FROM FinancialEventsRaw",
    "FeeEvents": f"""
        SELECT * REPLACE ('billed' AS BillingStatus) FROM FeeEventsRaw
        UNION ALL
        SELECT 'FEE-' || k.first, k.CustomerId, k.AssetId, 'custody', 15, 100, 1000, k.m, last_day(k.m), 'billed', 'INV-' || k.first
          FROM (SELECT CustomerId, AssetId, {_month('PositionDate')} AS m, MIN(ID) AS first FROM CustodyPositionsRaw GROUP BY 1, 2, 3) k
          LEFT JOIN (SELECT DISTINCT CustomerId, AssetId, {_month('FeePeriodStart')} AS m FROM FeeEventsRaw) f
            ON f.CustomerId = k.CustomerId AND f.AssetId = k.AssetId AND f.m = k.m
         WHERE f.m IS NULL""",
}


def _definitions(cleaned: bool) -> dict[str, str]:
    if not cleaned:
        return _ORDERED
    raw = {f"{name}Raw" if name in CLEANED else name: sql for name, sql in TABLES.items()}
    return {**raw, **CLEANED, **VIEWS}


def with_views(query: str, cleaned: bool = False) -> str:
    """Prefix a query with the common table expressions it needs, over the given tables or the cleaned ones."""
    known = _definitions(cleaned)

    def names_in(sql: str) -> set[str]:
        return set(re.findall(r"[A-Za-z]+", sql)) & set(known)

    needed, todo = set(), names_in(query)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= names_in(known[name]) - needed
    parts = ", ".join(f"{name} AS ({sql})" for name, sql in known.items() if name in needed)
    return f"WITH {parts} {query}"


def _check(name: str, rows: str, failing: str, text: str) -> str:
    return f"""
        SELECT '{name}' AS CheckName, '{K.CLOSE_CHECKS[name]}' AS Description, CAST(n AS BIGINT) AS FailingCount
             , CASE n WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS Status, COALESCE(s, 'None') AS SampleExceptions
          FROM (SELECT COUNT(*) FILTER ({failing}) AS n FROM {rows}),
               (SELECT STRING_AGG(t, ' | ' ORDER BY t) AS s FROM (
                  SELECT {text} AS t FROM {rows} WHERE {failing} AND {text} IS NOT NULL ORDER BY 1 LIMIT 5))"""


CHECKS = {
    "reconciliation_clean": _check(
        "reconciliation_clean", "Recon", "ReconciliationStatus <> 'Reconciled'",
        "CustomerName || ' / ' || Symbol || ' / ' || PositionPeriod || ': ' || ReconciliationStatus",
    ),
    "ledger_tieout_clean": _check(
        "ledger_tieout_clean", "Tie", "LedgerStatus <> 'MATCHED'",
        "CustomerId || ' / ' || AssetId || ' / ' || PositionPeriod || ': ' || LedgerStatus"
        " || COALESCE(' — ' || ExceptionDetail, '')",
    ),
    "no_pending_events": _check(
        "no_pending_events", "FinancialEvents", "Status = 'pending'",
        f"CustomerId || ' / ' || AssetId || ' / ' || {_month('PeriodDate')}",
    ),
    "all_fees_billed": _check(
        "all_fees_billed", "FeeEvents", "BillingStatus <> 'billed'",
        f"CustomerId || ' / ' || AssetId || ' / ' || FeeType || ' / ' || {_month('FeePeriodStart')}",
    ),
    "no_missing_positions": _check(
        "no_missing_positions", "Recon", "ReconciliationStatus = 'MissingPosition'",
        "CustomerName || ' / ' || Symbol || ' / ' || PositionPeriod",
    ),
    "kyc_approved_only": _check(
        "kyc_approved_only", "(SELECT * FROM Customers WHERE IsActive)", "KycStatus <> 'APPROVED'",
        "CustomerName || ' (KycStatus=' || KycStatus || ')'",
    ),
}


# The contracts, written out by hand: check, column, whether it is critical, and the rows or keys that fail.
_REPEATED = "(SELECT {0} FROM {1} WHERE {2} GROUP BY {0} HAVING COUNT(*) > 1)"


def _nulls(table: str, *columns: str) -> list[tuple]:
    return [("not_null", column, column not in ("FeeType",), f"{table} WHERE {column} IS NULL") for column in columns]


def _types(*columns: str) -> list[tuple]:
    """All columns of the given tables have the type that is asked for; contract_report_mistyped has a table that fails."""
    return [("column_type", column, column not in ("FeeType", "InvoiceReference"), "Customers WHERE FALSE") for column in columns]


def _unique(table: str, column: str) -> tuple:
    return ("unique", column, True, _REPEATED.format(column, table, f"{column} IS NOT NULL"))


def _grain(table: str, *columns: str) -> tuple:
    keys = ", ".join(columns)
    return ("grain", keys, True, _REPEATED.format(keys, table, " AND ".join(f"{c} IS NOT NULL" for c in columns)))


# A later state of the event log, without cancelled rows.
_LATER = "(SELECT * FROM FinancialEvents WHERE Status <> 'cancelled')"

CONTRACT_ROWS = {
    "CustodyPositions": [
        *_types("ID", "CustomerId", "AssetId", "PositionDate", "Quantity", "PriceUSD", "ValuationUSD", "CustodianLedgerRef"),
        *_nulls("CustodyPositions", "ID", "CustomerId", "AssetId", "PositionDate", "Quantity", "PriceUSD", "ValuationUSD"),
        ("accepted_range", "Quantity", True, "CustodyPositions WHERE Quantity < 0"),
        ("accepted_range", "PriceUSD", True, "CustodyPositions WHERE PriceUSD < 0"),
        ("relationship", "AssetId", True, "CustodyPositions WHERE AssetId NOT IN (SELECT AssetId FROM ReferenceAssets)"),
        ("valuation_consistent", "ValuationUSD", True, "CustodyPositions WHERE ABS(ValuationUSD - Quantity * PriceUSD) > 0.01"),
        ("hashed", "CustomerId", True, "CustodyPositions WHERE length(CustomerId) <> 64 OR regexp_matches(CustomerId, '[^0-9a-f]')"),
        _unique("CustodyPositions", "ID"),
        _grain("CustodyPositions", "CustomerId", "AssetId", "PositionDate"),
        ("period_end_reference", "CustodianLedgerRef", True, "Bal WHERE CustodianLedgerRef IS NULL"),
        ("snapshot_on_time", "PositionDate", True, "(SELECT PositionPeriod FROM Pos GROUP BY 1 "
         "HAVING MAX(CreatedAt) > PositionPeriod + INTERVAL 1 MONTH + INTERVAL 4 HOUR)"),
        ("freshness", "CreatedAt", True, "(SELECT MAX(CreatedAt) AS m FROM CustodyPositions) WHERE date_diff('second', m, TIMESTAMP '{run_at}') > 24 * 3600"),
    ],
    "StakingEvents": [
        *_types("ID", "CustomerId", "AssetId", "GrossAmount", "NetAmount", "FeeAmount", "RewardState", "EarnDate"),
        *_nulls("StakingEvents", "ID", "CustomerId", "AssetId", "GrossAmount", "NetAmount", "FeeAmount", "RewardState", "EarnDate"),
        ("accepted_range", "GrossAmount", True, "StakingEvents WHERE GrossAmount < 0"),
        ("accepted_range", "FeeAmount", True, "StakingEvents WHERE FeeAmount < 0"),
        ("accepted_values", "RewardState", True, "StakingEvents WHERE RewardState NOT IN ('pending', 'settled')"),
        ("net_reward_consistent", "NetAmount", True, "StakingEvents WHERE ABS(GrossAmount - FeeAmount - NetAmount) > 0.0001"),
        _unique("StakingEvents", "ID"),
        _grain("StakingEvents", "CustomerId", "AssetId", "EarnDate", "RewardType"),
    ],
    "FeeEvents": [
        *_types("ID", "CustomerId", "AssetId", "FeeType", "FeeAmountUSD", "BillingStatus", "InvoiceReference"),
        *_nulls("FeeEvents", "ID", "CustomerId", "AssetId", "FeeType", "FeeAmountUSD", "BillingStatus"),
        ("accepted_range", "FeeAmountUSD", True, "FeeEvents WHERE FeeAmountUSD < 0"),
        ("accepted_values", "FeeType", False, "FeeEvents WHERE FeeType NOT IN ('custody', 'staking', 'trading')"),
        ("accepted_values", "BillingStatus", True, "FeeEvents WHERE BillingStatus NOT IN ('invoiced', 'pending')"),
        ("invoice_reference", "InvoiceReference", False, "FeeEvents WHERE BillingStatus = 'invoiced' AND InvoiceReference IS NULL"),
        _unique("FeeEvents", "ID"),
        _grain("FeeEvents", "CustomerId", "AssetId", "FeeType", "FeePeriodStart"),
    ],
    "FinancialEvents": [
        *_types("ID", "CustomerId", "AssetId", "EventType", "GrossAmount", "NetAmount", "PeriodDate", "Status"),
        *_nulls(_LATER, "ID", "CustomerId", "AssetId", "EventType", "GrossAmount", "NetAmount", "PeriodDate", "Status"),
        _unique(_LATER, "ID"),
        ("append_only", "ID", True, "FinancialEvents WHERE Status IN ('pending', 'cancelled')"),
    ],
    "Customers": [
        *_types("CustomerId", "CustomerName", "KycStatus", "IsActive"),
        *_nulls("Customers", "CustomerId", "CustomerName", "KycStatus", "IsActive"),
        ("accepted_values", "KycStatus", True, "Customers WHERE KycStatus NOT IN ('APPROVED', 'PENDING', 'SUSPENDED')"),
        _unique("Customers", "CustomerId"),
    ],
    "ReferenceAssets": [
        *_types("AssetId", "Symbol", "AssetName", "IsStakeable"),
        *_nulls("ReferenceAssets", "AssetId", "Symbol", "AssetName", "IsStakeable"),
        _unique("ReferenceAssets", "AssetId"),
        _unique("ReferenceAssets", "Symbol"),
    ],
}


def contract_rows(table: str, run_at: object) -> str:
    """One row per check of a contract, each counted on its own."""
    parts = [
        f"SELECT '{table}' AS TableName, '{check}' AS CheckName, '{column}' AS ColumnName, {critical} AS Critical"
        f", n AS FailingCount, CASE n WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS Status"
        f" FROM (SELECT COUNT(*) AS n FROM {failing.replace('{run_at}', str(run_at))})"
        for check, column, critical, failing in CONTRACT_ROWS[table]
    ]
    return " UNION ALL ".join(parts)


def calc_columns(table: str) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in sorted(CALCS[table].items()))


def wide(table: str) -> str:
    """Base columns followed by the calcs under a ``calc_`` prefix."""
    calcs = ", ".join(f"{sql} AS calc_{name}" for name, sql in sorted(CALCS[table].items()))
    return f"SELECT {_doubles(*AMOUNTS[table])}, {calcs} FROM {table}"


def report_columns(config: dict = CUSTODY_MONTHLY) -> str:
    ordered = sorted(config["columns"], key=lambda spec: spec["order"])
    return ", ".join(
        f"CAST({spec['name']} AS DOUBLE) AS {spec['name']}" if spec["name"] in STATEMENT_AMOUNTS else spec["name"]
        for spec in ordered
    )
