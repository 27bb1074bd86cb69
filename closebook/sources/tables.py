"""Reading and storing tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.schemas import FACTS, SCHEMAS, SemanticTables
from closebook.session import delete

# The date that decides the month of a fact, and the partition column of facts that are stored by month.
DATE_OF = {"CustodyPositions": "PositionDate", "StakingEvents": "EarnDate", "FeeEvents": "FeePeriodStart", "FinancialEvents": "PeriodDate"}
MONTH = "Month"
LOADED_AT = "_LoadedAt"


def read_semantic(spark: SparkSession, name: str, location: str, file_format: str = "parquet") -> DataFrame:
    """Scan one semantic table with its declared schema; nothing is inferred."""
    return spark.read.schema(SCHEMAS[name]).format(file_format).load(f"{location.rstrip('/')}/{name}")


def with_load_time(rows: DataFrame) -> DataFrame:
    """A scan of files with the time each row's file was written, for tables that hold no load time of their own."""
    return rows.withColumn(LOADED_AT, F.col("_metadata.file_modification_time"))


def read_all(spark: SparkSession, location: str, file_format: str = "parquet") -> SemanticTables:
    return SemanticTables(**{name: read_semantic(spark, name, location, file_format) for name in SCHEMAS})


def read_catalog(spark: SparkSession, database: str) -> SemanticTables:
    """The six tables from the catalog."""
    return SemanticTables(**{name: spark.table(f"{database}.{name}") for name in SCHEMAS})


def month_before(period: date) -> date:
    return (period.replace(day=1) - timedelta(days=1)).replace(day=1)


def needed_months(period: date) -> Mapping[str, tuple[date, ...]]:
    """The months of each fact that closing ``period`` reads: changes against the month before need its positions and rewards."""
    both, one = (month_before(period), period), (period,)
    return {"CustodyPositions": both, "StakingEvents": both, "FeeEvents": one, "FinancialEvents": one}


def months_of(tables: SemanticTables, period: date) -> SemanticTables:
    """The facts that closing ``period`` reads."""

    def part(name: str, months: Sequence[date]) -> DataFrame:
        day = F.col(DATE_OF[name])
        return tables[name].filter((day >= F.lit(months[0])) & (day < F.add_months(F.lit(months[-1]), 1)))

    return replace(tables, **{name: part(name, months) for name, months in needed_months(period).items()})


def store_by_month(tables: SemanticTables, location: str) -> None:
    """All six tables below ``location`` in their declared types, facts partitioned by month; facts without a date have a partition of their own."""
    for name in SCHEMAS:
        rows = conform(tables[name], name)
        if name in FACTS:
            rows = rows.withColumn(MONTH, F.trunc(DATE_OF[name], "MM"))
        store(rows, f"{location.rstrip('/')}/{name}", [MONTH] if name in FACTS else [])


def read_months(spark: SparkSession, location: str, period: date) -> SemanticTables:
    """What closing ``period`` needs of tables that :func:`store_by_month` wrote; other months' files are not opened."""

    def part(name: str) -> DataFrame:
        if name not in FACTS:
            return read_semantic(spark, name, location)
        schema = T.StructType([*SCHEMAS[name], T.StructField(MONTH, T.DateType())])
        stored = spark.read.schema(schema).parquet(f"{location.rstrip('/')}/{name}")
        return stored.filter(F.col(MONTH).isin(*needed_months(period)[name])).drop(MONTH)

    return SemanticTables(**{name: part(name) for name in SCHEMAS})


def replace_month(df: DataFrame, path: str, period: date, column: str = "PositionPeriod") -> None:
    """Put the rows of one month in the place of that month's partition of a stored table, and touch no other.

    The new files are complete before the old ones go. A month that no longer has rows loses its partition.
    """
    rows = df.filter(F.col(column) == F.lit(period))
    if rows.isEmpty():
        delete(df.sparkSession, f"{path.rstrip('/')}/{column}={period:%Y-%m-%d}")
        return
    placed = rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    placed.partitionBy(column).parquet(path)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast the columns of a table to its declared schema."""
    return df.select(*[df[column.name].cast(column.dataType).alias(column.name) for column in SCHEMAS[name]])


def store(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a stored table.

    With ``partition_by`` the rows are rebalanced on those columns first: small partitions share a
    file, and a large one is split over several tasks.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def store_table(df: DataFrame, name: str) -> None:
    """Full refresh of a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def store_bucketed(df: DataFrame, name: str, by: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Full refresh of a catalog table that is dealt to buckets by a hash of some columns, and what a scan of it gives.

    Joins and aggregates whose keys include these columns need no exchange, if the other side has as many buckets. Rows are
    brought together first, so a bucket is one file and not one per task.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> None:
    """Publish a lazy result under a name for SQL users of the session."""
    df.createOrReplaceTempView(name)
