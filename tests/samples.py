"""Small hand-made tables: rows are given as dicts, everything not given is NULL."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from closebook.plans.books import Books
from closebook.schemas import SCHEMAS, SemanticTables
from pyspark.sql import types as T


def rows(spark, table, *records):
    """A semantic table from dicts; numbers become decimals where the schema says so."""
    schema = SCHEMAS[table]

    def value(field, record):
        given = record.get(field.name)
        if given is not None and isinstance(field.dataType, T.DecimalType):
            return Decimal(str(given))
        return given

    return spark.createDataFrame([[value(f, r) for f in schema] for r in records], schema)


def asset(key, stakeable=True, days=0):
    return {"AssetId": f"ASSET_{key}", "Symbol": key, "AssetName": key.title(), "IsStakeable": stakeable, "UnbondingDays": days}


def client(key, kyc="APPROVED", active=True, **more):
    return {"CustomerId": key, "CustomerName": f"Client {key}", "KycStatus": kyc, "IsActive": active, **more}


def position(key, day, quantity=2, price=10, value=None, ref="REF", client="C1", asset="ETH", **more):
    record = {
        "ID": key, "CustomerId": client, "AssetId": f"ASSET_{asset}", "PositionDate": day, "Quantity": quantity,
        "PriceUSD": price, "ValuationUSD": Decimal(str(quantity)) * Decimal(str(price)) if value is None else value, "CustodianLedgerRef": ref,
        "CreatedAt": datetime(2025, 1, 1),
    }
    return {**record, **more}


def reward(key, earned, net, gross=None, fee=0, state="settled", client="C1", asset="ETH", **more):
    record = {
        "ID": key, "CustomerId": client, "AssetId": f"ASSET_{asset}", "GrossAmount": net if gross is None else gross,
        "FeeAmount": fee, "NetAmount": net, "EarnDate": earned, "RewardState": state,
    }
    return {**record, **more}


def fee(key, start, amount=5, status="billed", invoice=None, kind="custody", client="C1", asset="ETH", **more):
    record = {
        "ID": key, "CustomerId": client, "AssetId": f"ASSET_{asset}", "FeeType": kind, "BasisPoints": 15,
        "FeeAmountUSD": amount, "AumAtBilling": 1000, "FeePeriodStart": start, "FeePeriodEnd": start,
        "BillingStatus": status, "InvoiceReference": invoice,
    }
    return {**record, **more}


def event(key, period, status="settled", client="C1", asset="ETH", **more):
    record = {
        "ID": key, "CustomerId": client, "AssetId": f"ASSET_{asset}", "EventType": "custody_deposit", "GrossAmount": 3,
        "NetAmount": 2, "EventTimestamp": datetime(2025, 3, 5, 12), "PeriodDate": period,
        "SettlementDate": date(2025, 3, 6), "Status": status, "ProductLine": "custody",
    }
    return {**record, **more}


def tables(spark, positions=(), rewards=(), fees=(), events=(), clients=None, assets=None):
    return SemanticTables(
        Customers=rows(spark, "Customers", *(clients or [client("C1")])),
        ReferenceAssets=rows(spark, "ReferenceAssets", *(assets or [asset("ETH"), asset("BTC", False)])),
        CustodyPositions=rows(spark, "CustodyPositions", *positions),
        StakingEvents=rows(spark, "StakingEvents", *rewards),
        FeeEvents=rows(spark, "FeeEvents", *fees),
        FinancialEvents=rows(spark, "FinancialEvents", *events),
    )


def books(spark, **given):
    options = {key: given.pop(key) for key in ("hot_rows", "entity") if key in given}
    return Books(tables(spark, **given), **options)
