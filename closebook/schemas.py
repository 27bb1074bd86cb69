"""Explicit schemas of the six semantic tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "numeric": NUMERIC,
    "bool": T.BooleanType(),
    "long": T.LongType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


CUSTOMERS = _schema(
    CustomerId="string", CustomerName="string", CustomerType="string", Jurisdiction="string",
    RiskTier="string", KycStatus="string", IsActive="bool",
)
REFERENCE_ASSETS = _schema(
    AssetId="string", Symbol="string", AssetName="string", AssetType="string",
    Protocol="string", IsStakeable="bool", UnbondingDays="long",
)
CUSTODY_POSITIONS = _schema(
    ID="string", CustomerId="string", AssetId="string", PositionDate="date", Quantity="numeric",
    PriceUSD="numeric", ValuationUSD="numeric", CustodianLedgerRef="string", CreatedAt="timestamp",
)
STAKING_EVENTS = _schema(
    ID="string", CustomerId="string", AssetId="string", GrossAmount="numeric", FeeAmount="numeric",
    NetAmount="numeric", EarnDate="date", SettleDate="date", DistributeDate="date", RewardState="string",
    RewardType="string",
)
FEE_EVENTS = _schema(
    ID="string", CustomerId="string", AssetId="string", FeeType="string", BasisPoints="long",
    FeeAmountUSD="numeric", AumAtBilling="numeric", FeePeriodStart="date", FeePeriodEnd="date",
    BillingStatus="string", InvoiceReference="string",
)
FINANCIAL_EVENTS = _schema(
    ID="string", CustomerId="string", AssetId="string", EventType="string", GrossAmount="numeric",
    NetAmount="numeric", EventTimestamp="timestamp", PeriodDate="date", SettlementDate="date",
    Status="string", ProductLine="string",
)

SCHEMAS = {
    "Customers": CUSTOMERS,
    "ReferenceAssets": REFERENCE_ASSETS,
    "CustodyPositions": CUSTODY_POSITIONS,
    "StakingEvents": STAKING_EVENTS,
    "FeeEvents": FEE_EVENTS,
    "FinancialEvents": FINANCIAL_EVENTS,
}
FACTS = ("CustodyPositions", "StakingEvents", "FeeEvents", "FinancialEvents")


@dataclass(frozen=True)
class SemanticTables:
    """The six inputs, one batch DataFrame each."""

    Customers: DataFrame
    ReferenceAssets: DataFrame
    CustodyPositions: DataFrame
    StakingEvents: DataFrame
    FeeEvents: DataFrame
    FinancialEvents: DataFrame

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)
