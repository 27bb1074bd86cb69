"""Calc tables and widetables.

All row-wise calcs of a group are one projection over the base table, which equals joining one
two-column table per calc on the unique ID but needs no shuffle. Lookup calcs add one left join to
the looked-up table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions.calcs import Calc, base_table, calcs_of
from closebook.operators.skew import broadcast_if_small


def _attach(base: DataFrame, calc: Calc, lookups: Mapping[str, DataFrame], how: str) -> DataFrame:
    """Join the looked-up row as a struct column named after its table."""
    table = lookups[calc.lookup_table]
    row = table.select(
        F.col(calc.lookup_key).alias("_key"), F.struct("*").alias(f"_{calc.lookup_table}")
    )
    match = base[calc.lookup_key] == F.col("_key")
    return base.join(broadcast_if_small(row), match, how).drop("_key")


def micro_calc(base: DataFrame, calc: Calc, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """ID and the one column of ``calc``; rows without a lookup partner are absent."""
    if calc.lookup_table:
        joined = _attach(base, calc, lookups or {}, "inner")
        base = joined.withColumnRenamed(f"_{calc.lookup_table}", "lookup")
    return base.select("ID", calc.expression().alias(calc.name))


def _with_calcs(base: DataFrame, group: str, lookups: Mapping[str, DataFrame]) -> tuple[DataFrame, list[Column]]:
    """The base rows with lookup structs attached, and the calc columns over them."""
    columns: list[Column] = []
    attached: set[str] = set()
    known_id = F.col("ID").isNotNull()
    for calc in calcs_of(group):
        if not calc.lookup_table:
            columns.append(F.when(known_id, calc.expression()).alias(calc.name))
            continue
        struct = f"_{calc.lookup_table}"
        if struct not in attached:
            base = _attach(base, calc, lookups, "left")
            attached.add(struct)
        # An expression sees its lookup row as ``lookup``; an unmatched row yields NULL.
        result = f"_calc_{calc.name}"
        base = base.withColumn("lookup", F.col(struct))
        base = base.withColumn(result, F.when(known_id & F.col("lookup").isNotNull(), calc.expression())).drop("lookup")
        columns.append(F.col(result).alias(calc.name))
    return base, columns


def calc_table(base: DataFrame, group: str, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame | None:
    """ID plus one column per calc of the group in name order; None for a group without calcs."""
    if not calcs_of(group):
        return None
    rows, columns = _with_calcs(base, group, lookups or {})
    return rows.select("ID", *columns)


def wide_table(base: DataFrame, group: str, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Two struct columns: the base row and its calcs. Rows without an ID drop out."""
    names = base.columns
    rows, columns = _with_calcs(base.filter(F.col("ID").isNotNull()), group, lookups or {})
    return rows.select(
        F.struct(*names).alias(base_table(group)),
        F.struct(F.col("ID"), *columns).alias(group),
    )


def join_calc_tables(base: DataFrame, calcs: DataFrame, group: str) -> DataFrame:
    """Widetable from a calc table that is already stored, joined to its base on ID."""
    left = base.select("ID", F.struct(*base.columns).alias(base_table(group)))
    right = calcs.select("ID", F.struct(*calcs.columns).alias(group))
    return left.join(right, "ID").drop("ID")
