"""Size-checked broadcasts and salting of hot keys.

One client's asset in one month may hold a large share of all positions. Such a key is split over
several tasks by a salt column that every join along the position spine carries:

* ``hot_keys`` finds the keys above a row threshold. There are fewer than rows / threshold of them, a
  millionth of the rows at the default, so this table, and only this table, is broadcast without
  looking at its size.
* ``latest_per_key`` numbers the rows of a hot key 0..fan-1; all other rows get salt 0.
* ``spread`` repeats the (few) right-hand rows of a hot key once per salt.

Where ``all_small`` finds that not even a client has that many rows, there is nothing to salt. All rows are
then dealt by client once (``dealt``), and what follows along the spine finds them where it needs them.

Where keys have more rows than asked for, but no client more than a task takes, rows are dealt by client as well.
``latest_with_fan`` finds the hot keys among them on the spot, and only their rows go on by salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
GROUPS = 1 << 16  # of hashed values whose rows all_small counts together
TASK_ROWS = 100_000  # rows of the counted table that a task gets with tasks_for, together with what is joined to them

SALT = "_salt"
FAN = "_fan"
LATEST = "_latest"
FAN_BEFORE = "_fan_before"  # of the same client and asset a month earlier, and a month later
FAN_AFTER = "_fan_after"


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the planner's own size estimate is below ``limit``."""
    if not hasattr(df, "_jdf"):  # a Connect session shows no statistics: leave the choice to Spark
        return df
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def estimated_bytes(df: DataFrame) -> int:
    """The planner's own estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def surely_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the planner's own estimate of a table's size says that it may be broadcast; without an estimate (see above) not."""
    return hasattr(df, "_jdf") and estimated_bytes(df) <= (BROADCAST_LIMIT_BYTES if limit is None else limit)


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keys with more than ``min_rows`` rows, the number of salts each gets and its greatest ``order``.

    The counts are combined map-side, so even one key holding most rows sends one row per task. A key
    gets one salt per ``min_rows`` rows.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max(order).alias(LATEST))
    fan = F.ceil(F.col("_rows") / min_rows).cast("int")
    return counted.filter(F.col("_rows") > min_rows).select(*keys, fan.alias(FAN), LATEST)


def dealt(df: DataFrame, by: Sequence[int | str]) -> DataFrame:
    """Rows brought together by some columns (first, if it is given, the number of tasks), or as they are.

    Groups, windows and joins of rows that are dealt alike need no exchange, if their keys include these columns.
    """
    return df.repartition(*by) if by else df


def all_small(df: DataFrame | Sequence[DataFrame], key: str, min_rows: int = HOT_ROWS) -> bool:
    """Whether certainly no value of ``key`` has more than ``min_rows`` rows in a table, or in any of several.

    Rows are counted by groups of hashed values, so a task sends a short list of counts however many values it holds.
    Thresholds below the number of groups are not worth the scan: such groups hold many values each.
    """
    if min_rows < GROUPS:
        return False
    return _group_counts([df] if isinstance(df, DataFrame) else df, key).filter(F.col("_rows") > min_rows).isEmpty()


def rows_if_small(tables: Sequence[DataFrame], key: str, min_rows: int = HOT_ROWS) -> int | None:
    """The rows of the first table if :func:`all_small` holds for all of them, else None; found by the same job."""
    if min_rows < GROUPS:
        return None
    of_first = F.sum(F.when(F.col("_table") == 0, F.col("_rows")))
    found = _group_counts(tables, key).agg(F.max("_rows").alias("largest"), of_first.alias("rows")).first()
    return None if (found["largest"] or 0) > min_rows else found["rows"] or 0


def _group_counts(tables: Sequence[DataFrame], key: str) -> DataFrame:
    groups = [table.select(F.lit(n).alias("_table"), F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias("_group")) for n, table in enumerate(tables)]
    return reduce(DataFrame.unionByName, groups).groupBy("_table", "_group").agg(F.count(F.lit(1)).alias("_rows"))


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """How many tasks to deal so many rows to, at least as many as shuffle partitions; None where one task would do.

    A number given to :func:`dealt` holds: Spark merges no tasks then, so what a task sorts and adds up stays in its memory,
    however few shuffle partitions are set for the rows.
    """
    needed = -(-rows // TASK_ROWS)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), needed) if needed > 1 else None


def _salt(by: Sequence[str]) -> Column:
    return F.when(F.col(FAN).isNull(), 0).otherwise(F.pmod(F.xxhash64(*by), FAN).cast("int"))


def spread(df: DataFrame, hot: DataFrame, keys: Sequence[str], only_hot: bool = False) -> DataFrame:
    """Repeat the rows of hot keys once per salt; other rows get salt 0, or drop out with ``only_hot``."""
    marked = df.join(F.broadcast(hot), list(keys), "inner" if only_hot else "left")
    # LATEST is never NULL for a hot key. Reading it here makes every use of the hot keys ask for the
    # same columns, so that Spark computes and broadcasts them once.
    fan = F.when(F.col(LATEST).isNotNull(), F.col(FAN)).otherwise(1)
    return marked.withColumn(SALT, F.explode(F.sequence(F.lit(0), fan - 1))).drop(FAN, LATEST)


def among(df: DataFrame, hot: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Only the rows of hot keys, without asking the dealt rows or the hot keys for other columns than elsewhere; all rows without ``hot``.

    ``keys`` are named as in ``df``, in the order of those of ``hot``.
    """
    if hot is None:
        return df
    names = dict(zip(keys, hot.columns))
    found = shared(df.withColumnsRenamed(names).join(F.broadcast(hot), hot.columns[: len(keys)]))
    return found.withColumnsRenamed({new: old for old, new in names.items()}).select(*df.columns)


def join_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None, only_hot: bool = False) -> DataFrame:
    """Left join; when ``left`` is salted, ``right`` is spread to match; with ``only_hot`` all keys of ``left`` are hot.

    Both sides of a salted join are dealt by all keys and the salt, lest it takes place by fewer and undoes the salt.
    """
    if SALT not in left.columns:
        return left.join(right, list(keys), "left")
    if hot is None:
        raise ValueError("salted rows need the hot keys they were salted with")
    by = [*keys, SALT]
    return dealt(left, by).join(dealt(spread(right, hot, keys, only_hot), by), by, "left")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, hot: DataFrame | None, by: Sequence[str], deal: Sequence[int | str] = ()
) -> DataFrame:
    """All rows on the greatest ``order`` value of their key (ties kept), with their salt.

    Rows with a NULL key or order value drop out. For hot keys the greatest value is already known,
    so their rows are filtered before anything is shuffled; all others go through a
    rank window, which Spark limits per map task before the shuffle. Without ``hot`` no key is, and rows get no salt;
    they may be dealt by some of the keys (see :func:`dealt`) instead.
    """
    present = df.dropna(subset=[*keys, order])
    if hot is None:
        newest_first = Window.partitionBy(*keys).orderBy(F.desc(order))
        return dealt(present, deal).withColumn("_rank", F.rank().over(newest_first)).filter("_rank = 1").drop("_rank")
    marked = present.join(F.broadcast(hot), list(keys), "left").filter(
        F.col(LATEST).isNull() | (F.col(LATEST) == F.col(order))
    )
    salted = marked.withColumn(SALT, _salt(by)).drop(FAN, LATEST)
    newest_first = Window.partitionBy(*keys, SALT).orderBy(F.desc(order))
    return salted.withColumn("_rank", F.rank().over(newest_first)).filter("_rank = 1").drop("_rank")


def shared(df: DataFrame) -> DataFrame:
    """The same rows, of which every use asks for all columns, so that Spark deals what they are made from once.

    For the results of sums and windows over dealt rows; the condition is always true.
    """
    return df.filter(F.hash(*df.columns) >= F.lit(-(1 << 31)))


def stacked(first: DataFrame, second: DataFrame) -> DataFrame:
    """The rows of both, under column names given anew.

    A union keeps the columns of its first part as they are; without new ones Spark would not see that both parts are made
    from the same dealt rows, and deal them twice.
    """
    return first.select(*[F.col(name).alias(name) for name in first.columns]).unionByName(second)


def latest_with_fan(df: DataFrame, keys: Sequence[str], order: str, by: Sequence[str], deal: Sequence[int | str], min_rows: int) -> DataFrame:
    """As :func:`latest_per_key`, with the salt and the number of salts (NULL unless the key is hot), in one pass over dealt rows.

    For tables where all rows of a value of the columns they are dealt by fit a task. The keys are asked for one by one, as
    joins do, or they would ask again and have the rows dealt anew.
    """
    same = Window.partitionBy(*keys)
    present = dealt(df.filter(reduce(Column.__and__, [F.col(name).isNotNull() for name in (*keys, order)])), deal)
    counted = shared(present.withColumns({"_rows": F.count(F.lit(1)).over(same), LATEST: F.max(order).over(same)}))
    fan = F.when(F.col("_rows") > min_rows, F.ceil(F.col("_rows") / min_rows).cast("int"))
    latest = counted.filter(F.col(LATEST) == F.col(order)).withColumn(FAN, fan).drop("_rows", LATEST)
    return latest.withColumn(SALT, _salt(by))


def place_by_key(df: DataFrame, keys: Sequence[str], by: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Bring the rows of a key into one task, and those of a hot key into several, for writing files.

    There is a task for every ``min_rows`` rows, and at least as many as shuffle partitions, because
    with many small files creating them is what takes the time.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // min_rows))
    hot = hot_keys(df.dropna(subset=list(keys)), keys, order=by[0], min_rows=min_rows)
    marked = df.join(F.broadcast(hot), list(keys), "left")
    return marked.repartition(tasks, *keys, _salt(by)).drop(FAN, LATEST)
