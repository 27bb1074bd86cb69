"""The six semantic tables, derived by Spark from the given test tables.

All customers, orders, line items and events are used, so the tables grow with the data. The SQL
counterpart is in :mod:`checks.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.schemas import SemanticTables

# The identifiers that the calcs know, one for each last digit of a part's key.
ASSET_IDS = (
    "ASSET_BTC", "ASSET_ETH", "ASSET_SOL", "ASSET_DOT", "ASSET_ADA", "ASSET_ATOM", "ASSET_AVAX", "ASSET_MATIC", "ASSET_USDC", "ASSET_USDT",
)
# Client type per market segment.
CLIENT_TYPES = {
    "BUILDING": "INSTITUTIONAL",
    "AUTOMOBILE": "HEDGE_FUND",
    "MACHINERY": "ASSET_MANAGER",
    "HOUSEHOLD": "PENSION_FUND",
}
OTHER_CLIENT_TYPE = "FAMILY_OFFICE"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"))


def _asset_id(number: Column) -> Column:
    ids = F.array(*[F.lit(key) for key in ASSET_IDS])
    return F.element_at(ids, (number % 10 + 1).cast("int"))


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def reference_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One asset per last digit of the part keys; all but the identifier follows from these parts."""
    digit = F.col("p_partkey") % 10
    groups = _read(spark, sf_dir, "part").groupBy(digit.alias("digit")).agg(
        F.min("p_name").alias("name"), F.min("p_brand").alias("protocol"), F.max("p_size").alias("size"), F.count("*").alias("parts")
    )
    stable = F.col("digit") >= 8
    stakeable = ~stable & (F.col("digit") > 0)
    # One row per digit, however large the plan thinks it is.
    return F.broadcast(groups).select(
        _asset_id(F.col("digit")).alias("AssetId"),
        F.substring_index(_asset_id(F.col("digit")), "_", -1).alias("Symbol"),
        F.col("name").alias("AssetName"),
        F.when(stable, "stablecoin").when(stakeable, "staking").otherwise("custody_only").alias("AssetType"),
        F.col("protocol").alias("Protocol"),
        stakeable.alias("IsStakeable"),
        F.when(stakeable, F.greatest((F.col("digit") - 2) * (F.col("digit") - 2) - 50 + F.col("size"), F.lit(0))).otherwise(0).cast("bigint").alias("UnbondingDays"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    client_type = F.lit(OTHER_CLIENT_TYPE)
    for segment, name in CLIENT_TYPES.items():
        client_type = F.when(F.col("c_mktsegment") == segment, name).otherwise(client_type)
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        _read(spark, sf_dir, "customer")
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            _text("CUST", key).alias("CustomerId"),
            F.col("c_name").alias("CustomerName"),
            client_type.alias("CustomerType"),
            F.col("n_name").alias("Jurisdiction"),
            F.when(key % 20 == 7, "PENDING").when(key % 20 == 13, "SUSPENDED").otherwise("APPROVED").alias("KycStatus"),
            F.when(balance >= 6000, "tier_1").when(balance >= 2000, "tier_2").otherwise("tier_3").alias("RiskTier"),
            (key % 37 != 0).alias("IsActive"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, one per order and line number (the raw table repeats some), with their order."""
    columns = {
        "l_partkey": "partkey", "l_quantity": "qty", "l_extendedprice": "ext", "l_discount": "disc",
        "l_shipdate": "ship", "l_returnflag": "rf", "l_linestatus": "ls",
    }
    # Dealt by order once, which serves both the groups and the join.
    lines = _read(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber")
    # The flags are single letters; as code points they allow hash aggregation.
    maxima = {raw: F.max(raw) for raw in columns}
    maxima |= {flag: F.chr(F.max(F.ascii(flag)).cast("bigint")) for flag in ("l_returnflag", "l_linestatus")}
    grouped = lines.agg(*[maxima[raw].alias(name) for raw, name in columns.items()])
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return grouped.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))


def _line_id(prefix: str) -> Column:
    return _text(prefix, F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def custody_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    value = _money("qty") * _money("p_retailprice") + F.when(F.col("l_linenumber") == 7, 5).otherwise(0)
    unconfirmed = (F.col("rf") == "R") & (F.col("l_linenumber") == 1)
    value = F.when(F.col("l_linenumber") != 6, value)  # positions that nobody has valued
    return (
        _lines(spark, sf_dir)
        .join(part, F.col("p_partkey") == F.col("partkey"))
        .select(
            _line_id("POS").alias("ID"),
            _text("CUST", "o_custkey").alias("CustomerId"),
            _asset_id(F.col("partkey")).alias("AssetId"),
            F.to_date("ship").alias("PositionDate"),
            _money("qty").alias("Quantity"),
            _money("p_retailprice").alias("PriceUSD"),
            value.cast("decimal(28,2)").alias("ValuationUSD"),
            F.when(~unconfirmed, _text("REF-", "l_orderkey")).alias("CustodianLedgerRef"),
            F.col("o_orderdate").alias("CreatedAt"),
        )
    )


def staking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stakeable = reference_assets(spark, sf_dir).filter("IsStakeable").select("AssetId", "UnbondingDays")
    earned, settled = F.to_date("o_orderdate"), F.col("ls") == "F"
    settle_date = F.date_add(earned, F.col("UnbondingDays").cast("int"))
    fee = (_money("ext") * F.col("disc").cast("decimal(4,2)")).cast("decimal(28,4)")
    lines = _lines(spark, sf_dir).withColumn("AssetId", _asset_id(F.col("partkey")))
    return lines.join(F.broadcast(stakeable), "AssetId").select(
        _line_id("STAKE").alias("ID"),
        _text("CUST", "o_custkey").alias("CustomerId"),
        "AssetId",
        _money("ext").alias("GrossAmount"),
        fee.alias("FeeAmount"),
        (_money("ext") - fee).cast("decimal(28,4)").alias("NetAmount"),
        earned.alias("EarnDate"),
        F.when(settled, settle_date).alias("SettleDate"),
        F.when(settled & (F.col("rf") == "A"), F.date_add(settle_date, 1)).alias("DistributeDate"),
        F.when(settled, "settled").otherwise("pending").alias("RewardState"),
        F.when(F.col("rf") == "R", "mev_reward").otherwise("block_reward").alias("RewardType"),
    )


def fee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    kind = key % 3
    amount = _money("o_totalprice")
    accrued = key % 11 == 0
    return _read(spark, sf_dir, "orders").select(
        _text("FEE", key).alias("ID"),
        _text("CUST", "o_custkey").alias("CustomerId"),
        _asset_id(key).alias("AssetId"),
        F.when(kind == 0, "custody").when(kind == 1, "staking").otherwise("premium_reporting_fee").alias("FeeType"),
        F.when(key % 89 == 0, 0).when(kind == 0, 15).when(kind == 1, 100).otherwise(5).cast("bigint").alias("BasisPoints"),
        F.when(key % 83 == 0, -amount).otherwise(amount).cast("decimal(18,2)").alias("FeeAmountUSD"),
        F.when(key % 97 == 0, 0).otherwise(amount * 100).cast("decimal(22,2)").alias("AumAtBilling"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("FeePeriodStart"),
        F.last_day(F.to_date("o_orderdate")).alias("FeePeriodEnd"),
        F.when(accrued, "accrued").when(key % 53 == 0, "waived").otherwise("billed").alias("BillingStatus"),
        F.when(~accrued, _text("INV-", key)).alias("InvoiceReference"),
    )


def financial_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_type")
    month = key % 80
    pending = (kind == "error") & (key % 5 == 0)
    period = F.make_date((F.lit(1995) + F.floor(month / 12)).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
    settle_date = F.date_add(F.to_date("ts"), (key % 4).cast("int"))
    return _read(spark, sf_dir, "events").select(
        _text("FE", key).alias("ID"),
        _text("CUST", "user_id").alias("CustomerId"),
        _asset_id(F.floor(key / 7)).alias("AssetId"),
        kind.alias("EventType"),
        _money("value").alias("GrossAmount"),
        (_money("value") * F.lit("0.9").cast("decimal(4,2)")).cast("decimal(28,4)").alias("NetAmount"),
        F.col("ts").alias("EventTimestamp"),
        period.alias("PeriodDate"),
        F.when(~pending, settle_date).alias("SettlementDate"),
        F.when(pending, "pending").when(key % 101 == 0, "cancelled").otherwise("settled").alias("Status"),
        F.when(kind == "click", "custody").when(kind == "view", "staking").otherwise("stablecoin").alias("ProductLine"),
    )


def semantic_tables(spark: SparkSession, sf_dir: str) -> SemanticTables:
    return SemanticTables(
        Customers=customers(spark, sf_dir),
        ReferenceAssets=reference_assets(spark, sf_dir),
        CustodyPositions=custody_positions(spark, sf_dir),
        StakingEvents=staking_events(spark, sf_dir),
        FeeEvents=fee_events(spark, sf_dir),
        FinancialEvents=financial_events(spark, sf_dir),
    )
