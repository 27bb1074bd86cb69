"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import TOKEN_PATTERN, keep, unit_interval

WEIGHTS = (5, 2, 1)
LIMIT = 3  # times a source's size
BUCKET = 10_000  # rows that are summed up in one task, as long as that takes at most ten times the shuffle partitions


def words(text: str) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_PATTERN)), F.lit(0)).cast("long")


def quality(text: str) -> Column:
    """Default quality weight, from 0.25 to 1: a text's share of letters."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.coalesce(0.25 + 0.75 * F.try_divide(letters.cast("double"), F.length(text)), F.lit(0.25))


def _keyed(docs: DataFrame, id_column: str, text: str, source: str, weight: Column) -> DataFrame:
    """Every row as ``_doc``, with ``_id``, ``_source``, ``_size``, ``_tie`` and ``_key``, the exponential of rate ``weight`` it is ordered by.

    The random number follows from id and text alone, so reruns and retried tasks agree.
    """
    tie = F.md5(F.coalesce(text, F.lit("")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_column).alias("_id"), F.col(source).alias("_source"),
        words(text).alias("_size"), tie.alias("_tie"), (-F.ln(unit_interval(id_column, tie)) / weight).alias("_key"),
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """``target`` words for every row of ``_source`` and ``source_size``.

    Sources in order (null last) have the weights in turn and share all words; a target stops at
    ``limit`` times its source, and what is over goes to the others by weight until none is above. That fixed
    point is a common level: target = min(limit * size, level * weight). In order of
    limit * size / weight the stopped sources come first, so running sums give it. The table has one row per source.
    """
    everything = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy("_ratio", "_rank").rowsBetween(0, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last()))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_rank", rank).withColumn("_weight", F.element_at(listed, (F.col("_rank") - 1) % len(weights) + 1))
    most = F.col("source_size") * F.lit(float(limit))
    ranked = ranked.withColumn("_most", most).withColumn("_ratio", most / F.col("_weight"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(earlier), F.lit(0.0))
    level = ranked.withColumn("_level", left / F.sum("_weight").over(later)).withColumn("_place", F.row_number().over(Window.orderBy("_ratio", "_rank")))
    first = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_place", "_level"))).over(everything)
    target = F.least(F.col("_most"), F.coalesce(first["_level"], F.col("_ratio")) * F.col("_weight"))
    return level.select("_source", "source_size", F.least(F.col("_most"), target).alias("target"))


def _plan(rows: DataFrame, weights: Sequence[float], limit: float) -> tuple[DataFrame, DataFrame]:
    """Per source: target, whole epochs and words left (``budget``); and every row of :func:`_narrow` with the words ``before`` it.

    The words before a row are those of the earlier ranges of its source plus those before it in its range.
    """
    sums = rows.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"))
    plan = targets(keep(sums, "sources"), weights, limit)
    epochs = F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double"))), F.lit(0))
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = plan.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    plan = keep(plan, "targets")

    known = plan.withColumnRenamed("_source", "_other")
    placed = rows.join(known, F.col("_source").eqNullSafe(F.col("_other"))).drop("_other")
    totals = rows.groupBy("_source", "_range").agg(F.sum(F.col("_size") * F.col("_n")).alias("_total"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(totals.withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0))), "offsets")
    offsets = offsets.select(F.col("_source").alias("_other"), F.col("_range").alias("_same"), "_offset")
    order = Window.partitionBy("_source", "_range").orderBy("_key", "_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum(F.col("_size") * F.col("_n")).over(order), F.lit(0)))
    met = F.col("_source").eqNullSafe(F.col("_other")) & (F.col("_range") == F.col("_same"))
    return plan, inside.join(offsets, met).withColumn("before", F.col("_inside") + F.col("_offset"))


def _narrow(docs: DataFrame, id_column: str, text: str, source: str, weight: Column | None) -> DataFrame:
    """Distinct keys with their number of rows (``_n``), in ranges (``_range``) of source and key.

    Rows equal in id and text share a key and are counted before anything moves. Ranges are cut where the keys
    are, so they have about equally many rows whatever the weights and sources.
    """
    weight = quality(text) if weight is None else weight
    rows = _keyed(docs, id_column, text, source, weight).groupBy("_id", "_source", "_size", "_tie", "_key").agg(F.count("*").alias("_n"))
    rows = keep(rows, "counted")
    most = 10 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(rows.count() // BUCKET + 1, most)
    ordered = rows.repartitionByRange(ranges, "_source", "_key", "_id", "_tie")
    return keep(ordered.withColumn("_range", F.spark_partition_id()), "keys")


def shares(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
    weights: Sequence[float] = WEIGHTS, limit: float = LIMIT,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words of every row of ``docs``.

    A source's target is first met by whole epochs of all its documents. What is left goes to a
    sample drawn without replacement with probabilities that follow ``weight`` (positive; by default
    :func:`quality`): documents in order of an exponential of that rate, until the words left are
    used up; the last one gives only as many as are missing. A null text has no words, a null
    source is a source, a null id is an id like any other. Rows that repeat one another are
    drawn one by one, one after another. Other columns are ignored; an empty table gives an empty result.
    """
    rows = _narrow(docs, id_column, text, source, weight)
    placed = keep(_plan(rows, weights, limit)[1], "placed")
    # A long run of copies is cut, and its parts go to different tasks before they are expanded.
    few, many = (placed.filter(c).select("_id", "_size", "source_size", "target", "epochs", "budget", "before", "_n") for c in (f"_n <= {BUCKET}", f"_n > {BUCKET}"))
    many = many.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BUCKET).cast("long")))).repartition("_id", "_first")
    many = many.withColumn("_n", F.least(F.col("_first") + BUCKET, F.col("_n")))
    copies = few.withColumn("_first", F.lit(0).cast("long")).unionByName(many)
    placed = copies.withColumn("_copy", F.explode(F.sequence("_first", F.col("_n") - 1)))
    part = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("budget") - F.col("before") - F.col("_copy") * F.col("_size")))
    return placed.select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("epochs") * F.col("_size") + part).alias("taken"),
    )


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
    weights: Sequence[float] = WEIGHTS, limit: float = LIMIT,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (perhaps never), with the same columns.

    As :func:`shares`, but documents stay whole: the last one of a source is taken if that comes
    nearer to the target. Only the last key of each source has to be known for that, so the
    documents themselves are not shuffled. Rows equal in id and text share a key and are taken or left together.
    """
    weight = quality(text) if weight is None else weight
    plan, placed = _plan(_narrow(docs, id_column, text, source, weight), weights, limit)
    near = (F.col("before") < F.col("budget")) & (F.col("_size") <= 2 * (F.col("budget") - F.col("before")))
    place = F.struct("_key", F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("id"), "_tie")
    last = placed.filter(near).groupBy("_source").agg(F.max(place).alias("_last"))
    last = last.withColumnRenamed("_source", "_other")
    known = plan.join(last, F.col("_source").eqNullSafe(F.col("_other")), "left").select(F.col("_source").alias("_other"), "epochs", "_last")
    known = keep(known, "mix")
    drawn = F.coalesce((place <= F.col("_last")).cast("int"), F.lit(0))
    keyed = _keyed(docs, id_column, text, source, weight)
    found = keyed.join(known, F.col("_source").eqNullSafe(F.col("_other"))).withColumn("_copies", (F.col("epochs") + drawn).cast("int"))
    found = found.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return found.select("_doc.*")
