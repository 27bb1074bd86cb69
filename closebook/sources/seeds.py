"""CSV seed files: header line, snake_case names, ``True``/``False``, empty field = NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.schemas import NUMERIC, SCHEMAS, SemanticTables
from closebook.session import scratch_path


def _seed(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_TEXT, _DATE, _TIME, _FLAG, _WHOLE = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.LongType()

# Seed files with their columns in file order and the type of each.
SEEDS = {
    "customers": _seed(
        ("customer_id", _TEXT), ("customer_name", _TEXT), ("customer_type", _TEXT), ("jurisdiction", _TEXT), ("onboarded_date", _DATE),
        ("kyc_status", _TEXT), ("risk_tier", _TEXT), ("is_active", _FLAG),
    ),
    "ref_assets": _seed(
        ("asset_id", _TEXT), ("symbol", _TEXT), ("asset_name", _TEXT), ("asset_type", _TEXT), ("protocol", _TEXT), ("is_stakeable", _FLAG),
        ("min_stake_amount", NUMERIC), ("unbonding_days", _WHOLE), ("coingecko_id", _TEXT),
    ),
    "raw_custody_positions": _seed(
        ("position_id", _TEXT), ("customer_id", _TEXT), ("asset_id", _TEXT), ("quantity", NUMERIC), ("price_usd", NUMERIC),
        ("valuation_usd", NUMERIC), ("position_date", _DATE), ("custodian_ledger_ref", _TEXT), ("created_at", _TIME),
    ),
    "raw_staking_events": _seed(
        ("event_id", _TEXT), ("customer_id", _TEXT), ("asset_id", _TEXT), ("validator_address", _TEXT), ("event_type", _TEXT),
        ("gross_amount", NUMERIC), ("fee_amount", NUMERIC), ("net_amount", NUMERIC), ("earn_date", _DATE), ("settle_date", _DATE),
        ("distribute_date", _DATE), ("reward_state", _TEXT), ("protocol_epoch", _TEXT), ("protocol_block_height", _TEXT),
        ("source_system", _TEXT), ("created_at", _TIME),
    ),
    "raw_financial_events": _seed(
        ("event_id", _TEXT), ("customer_id", _TEXT), ("asset_id", _TEXT), ("event_type", _TEXT), ("gross_amount", NUMERIC),
        ("fee_amount", NUMERIC), ("net_amount", NUMERIC), ("event_timestamp", _TIME), ("period_date", _DATE), ("settlement_date", _DATE),
        ("status", _TEXT), ("source_system", _TEXT), ("product_line", _TEXT), ("metadata_json", _TEXT), ("created_at", _TIME),
    ),
    "raw_fee_events": _seed(
        ("fee_id", _TEXT), ("customer_id", _TEXT), ("asset_id", _TEXT), ("fee_type", _TEXT), ("basis_points", _WHOLE),
        ("fee_amount_usd", NUMERIC), ("aum_at_billing", NUMERIC), ("fee_period_start", _DATE), ("fee_period_end", _DATE),
        ("billing_status", _TEXT), ("invoice_reference", _TEXT), ("created_at", _TIME),
    ),
}
SEED_OF_TABLE = {
    "Customers": "customers",
    "ReferenceAssets": "ref_assets",
    "CustodyPositions": "raw_custody_positions",
    "StakingEvents": "raw_staking_events",
    "FeeEvents": "raw_fee_events",
    "FinancialEvents": "raw_financial_events",
}
#: Semantic columns whose seed column has another name than the rule of pascal_case gives.
OTHER_NAMES = {("StakingEvents", "event_type"): "RewardType"}

_CORRUPT, _FILE, _REASON = "_corrupt", "_file", "_reason"
REJECTS = "Seed string, File string, Line string, Reason string"


class SeedRejected(Exception):
    """More lines of a seed file were rejected than the load allows; ``rejects`` is the folder that lists them."""

    def __init__(self, seed: str, count: int, rejects: str) -> None:
        super().__init__(f"{count} lines of seed {seed} were rejected, see {rejects}")
        self.count = count
        self.rejects = rejects


def read_seed(spark: SparkSession, seed: str, path: str) -> DataFrame:
    """One seed file (or folder of files) with its declared schema.

    A header with other names or another order raises, and so do malformed values of the columns that are used.
    """
    return (
        spark.read.schema(SEEDS[seed])
        .options(header=True, enforceSchema=False, mode="FAILFAST", escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def _parsed(column: T.StructField) -> tuple[Column, str]:
    """A field's text as its declared type, NULL if it is none, and what is then wrong with it."""
    text, kind = F.col(column.name), column.dataType
    if kind == _TEXT:
        return text, ""
    if kind == _FLAG:
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False), "not True or False"
    if kind == _DATE:
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date")), "not a date"
    if kind == _TIME:
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp")), "not a time"
    if kind == _WHOLE:
        return F.when(text.rlike(r"^[-+]?\d+$"), text.try_cast("bigint")), "not a whole number"
    return F.when(text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), text.try_cast(kind)), "not a number"


def _checked(spark: SparkSession, seed: str, path: str, header: bool) -> DataFrame:
    """Every line of a seed as text fields, with the line itself if it has too few or too many of them, its file, and why it is rejected."""
    schema = SEEDS[seed]
    texts = T.StructType([*[T.StructField(c.name, _TEXT) for c in schema], T.StructField(_CORRUPT, _TEXT)])
    options = {"header": header, "enforceSchema": not header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": '"'}
    lines = spark.read.schema(texts).options(**options).csv(path).withColumn(_FILE, F.col("_metadata.file_path"))
    reason = F.when(F.col(_CORRUPT).isNotNull(), "wrong number of fields")
    for column in schema:
        value, problem = _parsed(column)
        if problem:
            reason = reason.when(F.col(column.name).isNotNull() & value.isNull(), f"{column.name}: {problem}")
    return lines.withColumn(_REASON, reason)


def load_seed(
    spark: SparkSession, seed: str, path: str, rejects: str, max_rejects: int = 0, header: bool = True
) -> DataFrame:
    """The good lines of a seed file (or folder of files) in their declared types, after the bad ones went to ``rejects``.

    A line with too few or too many fields, or with a field that is not of its column's type, is rejected
    with its file, its text and the first reason; :func:`read_rejects` lists them. More than
    ``max_rejects`` of them fail the load, after they were written. A header with other names or another order raises.
    Parsed lines are kept in the shared folder, so files are read once.
    """
    checked = _checked(spark, seed, path, header)
    kept = scratch_path(spark, f"seed-{seed}")
    checked.write.parquet(kept)  # the corrupt line of a file cannot be asked for without its fields
    checked = spark.read.schema(checked.schema).parquet(kept)
    fields = [c.name for c in SEEDS[seed]]
    bad = checked.filter(F.col(_REASON).isNotNull())
    text = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*fields)))
    bad.select(F.lit(seed).alias("Seed"), F.col(_FILE).alias("File"), text.alias("Line"), F.col(_REASON).alias("Reason")).write.mode("append").parquet(rejects)
    count = bad.count()
    if count > max_rejects:
        raise SeedRejected(seed, count, rejects)
    good = checked.filter(F.col(_REASON).isNull())
    return good.select(*[_parsed(c)[0].cast(c.dataType).alias(c.name) for c in SEEDS[seed]])


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    return spark.read.schema(REJECTS).parquet(rejects)


def pascal_case(name: str) -> str:
    """price_usd -> PriceUSD, customer_id -> CustomerId."""
    return "".join("USD" if part == "usd" else part.capitalize() for part in name.split("_"))


def semantic_name(table: str, name: str) -> str:
    """The semantic name of a seed column; a fact's own key becomes ID."""
    own_key = SEEDS[SEED_OF_TABLE[table]][0].name
    if name == own_key and "ID" in SCHEMAS[table].names:
        return "ID"
    return OTHER_NAMES.get((table, name), pascal_case(name))


def to_semantic(seed_rows: DataFrame, table: str) -> DataFrame:
    """Rename seed columns to the semantic names."""
    names = {semantic_name(table, name): name for name in seed_rows.columns}
    return seed_rows.select(*[F.col(names[name]).alias(name) for name in SCHEMAS[table].names])


def read_seeds(spark: SparkSession, folder: str) -> SemanticTables:
    """All six tables from a folder of seed files."""
    return SemanticTables(
        **{
            table: to_semantic(read_seed(spark, seed, f"{folder.rstrip('/')}/{seed}.csv"), table)
            for table, seed in SEED_OF_TABLE.items()
        }
    )
