"""Sharding by weighted rendezvous hashing (operator 3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import keep

BUCKET = 10_000  # rows of a shard that are numbered in one task


def _unit(hashed: Column) -> Column:
    """A number in (0, 1) from the high 52 bits of a hash."""
    return (F.shiftrightunsigned(hashed, 12).cast("double") + 0.5) / F.lit(float(2**52))


def shard_of(keys: Sequence[str], weights: Sequence[float]) -> Column:
    """The shard (from 0) of a record: the one with the highest score -weight / ln(u).

    ``u`` is a uniform number that hangs on the record's keys and the shard's number alone, so
    a further shard only takes records that score highest there, in proportion to its weight, and no record
    moves between the others. Null keys are keys like any other.
    """
    scores = [
        F.struct((-F.lit(float(w)) / F.ln(_unit(F.xxhash64(*keys, F.lit(k))))).alias("score"), F.lit(-k).alias("shard"))
        for k, w in enumerate(weights)
    ]
    return (-F.greatest(*scores)["shard"] if len(scores) > 1 else F.lit(0)).cast("int")


def assign(docs: DataFrame, keys: Sequence[str] = ("doc_id",), weights: Sequence[float] = (1.0,) * 8, name: str = "shard") -> DataFrame:
    """``docs`` with the shard of every row, without a shuffle; a column of that name is replaced."""
    return docs.withColumn(name, shard_of(list(keys), weights))


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """Rows with ``slot``, their place in their shard from 0 without gaps.

    Equal rows are counted before anything moves and each count is expanded at the end, so a row that
    is repeated very often weighs no more than another; more than ``BUCKET`` copies are expanded in several tasks. Rows of a shard are in the order of a hash of all their columns,
    cut into ranges of about ``BUCKET`` rows that are numbered side by side.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_hash", F.xxhash64(*columns))
    counted = keep(counted, "rows")
    buckets = max(1, counted.count() // BUCKET)
    counted = counted.withColumn("_bucket", F.least(F.floor(_unit(F.col("_hash")) * buckets), F.lit(buckets - 1)))
    totals = counted.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_total"))
    earlier = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(totals.select(shard, "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")), "offsets")
    order = Window.partitionBy(shard, "_bucket").orderBy("_hash", *[c for c in columns if c != shard])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = keep(counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(offsets, [shard, "_bucket"]), "placed")
    placed = placed.withColumn("_first", F.col("_offset") + F.col("_before"))
    # A long run of copies is cut, and its parts go to different tasks before they are expanded.
    few, many = placed.filter(F.col("_n") <= BUCKET), placed.filter(F.col("_n") > BUCKET)
    parts = many.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BUCKET).cast("long"))))
    parts = parts.select(*columns, (F.col("_first") + F.col("_from")).alias("_first"), F.least(F.lit(BUCKET), F.col("_n") - F.col("_from")).alias("_n"))
    runs = few.select(*columns, "_first", "_n").unionAll(parts.repartition("_first"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    return runs.select(*columns, "_first", copy.alias("_copy")).select(*columns, (F.col("_first") + F.col("_copy")).alias("slot"))


def manifest(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 8, grown: float = 1.0
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    ``size`` is the text's UTF-8 bytes plus one (null text: 1, CRC of the empty text), ``grown_shard`` the
    shard with one more of weight ``grown``. The id alone decides, so texts and other columns don't matter, rows that
    repeat an id share a shard, and rows that repeat one another have slots of their own. An empty table gives an empty result.
    """
    key = F.col(id_column)
    narrow = docs.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    narrow = assign(narrow, ["doc_id"], weights)
    narrow = assign(narrow, ["doc_id"], [*weights, grown], "grown_shard")
    return numbered(narrow).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
