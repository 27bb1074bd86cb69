"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.session import configure, materialise

# The bytes A-Z and a-z, and the ASCII bytes that are no word characters.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words of lower-case text, and text between white space, in the form that Java matches fastest.
WORD_PATTERN = r"[0-9a-z\x{80}-\x{10FFFF}]+"
TOKEN_PATTERN = r"\S+"


# Rows that pass between Spark and Python at once: texts may be long, and both sides hold a batch.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, under the settings the library needs."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back."""
    return materialise(df, f"llm-{name}")


def free_prefix(columns: Iterable[str]) -> str:
    """Underscores with which none of the columns begins, for names of intermediate columns."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in columns), default=0))


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so (in either case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def unit_interval(*columns: Column | str) -> Column:
    """A number in (0, 1) that depends on the columns alone: the first 52 bits of an MD5, centred."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("~")) for c in columns]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2**52))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition that is sorted by ``keys``.

    A table holds as many groups as fit into ``rows`` rows, and at least one.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows < rows:
            continue
        cut = _last_group(held, keys)
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _last_group(held: pa.Table, keys: list[str]) -> int:
    """Row at which the last group starts."""
    last = held.slice(held.num_rows - 1, 1).select(keys).to_pylist()[0]
    low, high = 0, held.num_rows - 1
    columns = [held.column(k) for k in keys]
    while low < high:
        middle = (low + high) // 2
        if all(c[middle].as_py() == last[k] for c, k in zip(columns, keys, strict=True)):
            high = middle
        else:
            low = middle + 1
    return low
