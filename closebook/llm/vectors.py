"""Embedding near-duplicates by collision-counting projections (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import groups, keep
from closebook.llm.components import components
from closebook.llm.simhash import chunk_pairs, spread

COSINE = 0.98
PROJECTIONS = 32
WINDOW = 0.9  # half-width of a window, in standard deviations of a pair at the threshold
REACH = 4.0  # the same for the projection that cells are cut from
CELLS = 4  # cells within the reach
RECALL = 0.9995  # of pairs exactly at the threshold; closer ones are found more often
CHUNK = 512
VERIFY = 1 << 14  # pairs whose vectors are compared at once
SEED = 7


def deviation(cosine: float) -> float:
    """Standard deviation of the difference of a pair's projections, the distance of its unit vectors."""
    return sqrt(2 - 2 * cosine)


def least_count(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The most collisions that may be asked for while pairs at the threshold pass with ``recall``.

    Projections are independent normals, so the number of collisions of such a pair is binomial.
    """
    hit = erf(window / sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if below > 1 - recall:
            return count
    return projections


@cache
def directions(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Fixed normal directions; the first is the one that cells are cut from."""
    return np.random.default_rng(SEED + size).standard_normal((size, projections + 1))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def collisions(left: np.ndarray, right: np.ndarray, half: float) -> np.ndarray:
    """For every row of ``left`` and of ``right`` the number of projections in which they collide.

    The right side is sorted once per projection; the window around a left row is then a run of it.
    """
    counts = np.zeros(len(left) * len(right), dtype=np.int32)
    for k in range(left.shape[1]):
        order = np.argsort(right[:, k])
        values = right[order, k]
        low = np.searchsorted(values, left[:, k] - half, "left")
        n = np.searchsorted(values, left[:, k] + half, "right") - low
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        # Each pair occurs at most once per projection, so plain indexing adds it once.
        counts[np.repeat(np.arange(len(left)) * len(right), n) + order[inside]] += 1
    return counts.reshape(len(left), len(right))


def compare(vectors: np.ndarray, copies: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links per row, counting copies, and the smallest row each is connected with."""
    unit = units(vectors)
    shadows = unit @ directions(vectors.shape[1])[:, 1:]
    a, b = np.flatnonzero(first), np.flatnonzero(second)
    count = np.zeros(len(vectors), dtype=np.int64)
    labels = np.arange(len(vectors))
    if not len(a) or not len(b):
        return count, labels
    half, least = WINDOW * deviation(cosine), least_count()
    same = np.array_equal(a, b)
    step = max(1, (1 << 20) // len(b))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        x, y = np.nonzero(collisions(shadows[part], shadows[b], half) >= least)
        x, y = part[x], b[y]
        if same:
            x, y = x[x < y], y[x < y]
        for k in range(0, len(x), VERIFY):
            i, j = x[k : k + VERIFY], y[k : k + VERIFY]
            near = (unit[i] * unit[j]).sum(axis=1) >= cosine
            i, j = i[near], j[near]
            count += np.bincount(i, copies[j], len(count)).astype(np.int64)
            count += np.bincount(j, copies[i], len(count)).astype(np.int64)
            apart = labels[i] != labels[j]
            if apart.any():
                labels = spread(labels, i[apart], j[apart])
    return count, labels


def _usable(vector: str, label: str) -> F.Column:
    """Not null, not zero, finite throughout and labelled."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(
        F.col(label).isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False)
    )


def _key(vector: str, label: str) -> F.Column:
    """128 bits that stand for a label and a vector."""
    first, second = F.xxhash64(label, vector), F.xxhash64(F.lit(SEED), label, vector)
    return F.concat(F.lpad(F.hex(first), 16, "0"), F.lpad(F.hex(second), 16, "0"))


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows with the same label whose cosine (in double precision) is at least ``cosine`` are linked;
    a link is found with a probability of at least ``RECALL`` times that of the reach, and none is
    false. Equal vectors are compared once, with their number as a weight, and are linked with one
    another. Within a label, rows are cut into cells along one projection, cells into chunks of
    bounded size, and chunks of cells within reach are compared by the tasks; these return counts
    and connected sets rather than pairs.

    Rows without a label or with a vector that is null, empty, zero or holds null or non-finite
    components link with nothing and are their own component, as are all rows of an empty table.
    Vectors of different length are never compared. Rows that repeat an id give one row each; other
    columns are ignored. Within a label, comparisons grow with the square of the rows: a window of
    one projection holds a fixed share of them.
    """
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.transform(vector, lambda v: v.cast("double") + 0.0).alias("vector"), F.col(label).alias("label")
    )
    rows = rows.withColumn("usable", _usable("vector", "label")).withColumn("node", F.when(F.col("usable"), _key("vector", "label")))
    distinct = rows.filter("usable").groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    distinct = keep(distinct, "vectors")
    found = keep(_found(distinct, cosine), "links")
    totals = distinct.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    connected = components(found.filter("node <> root"), "node", "root")
    totals = totals.join(connected, "node", "left").select(
        "node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "node").alias("component")
    )
    totals = keep(totals, "totals")
    least = keep(totals.groupBy("component").agg(F.min("least").alias("least_id")), "least")
    totals = keep(totals.join(least, "component").select("node", "links", "least_id"), "vector-groups")
    component = F.coalesce("least_id", "vec_id")
    return rows.select("vec_id", "node").join(totals, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _found(distinct: DataFrame, cosine: float) -> DataFrame:
    """``node``, ``links`` and ``root`` of every distinct vector with a link, once per task that saw one."""
    reach = REACH * deviation(cosine)
    columns = ["node", "label", "copies", "vector"]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = []
            for vector in batch.column("vector"):
                v = np.array(vector.values)
                cell.append(int(np.floor((units(v[None, :])[0] @ directions(len(v))[:, 0]) * CELLS / reach)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(cell, pa.int32())], [*columns, "cell"]
            )

    schema = distinct.select(*columns).withColumn("cell", F.lit(0).cast("int")).schema
    placed = distinct.select(*columns).mapInArrow(cells, schema).withColumn("size", F.size("vector"))
    placed = keep(placed, "cells")
    # A row meets the rows of its own cell, of the next cells within reach (as the lower) and of
    # those before (as the upper).
    steps = F.explode(F.sequence(F.lit(-CELLS), F.lit(CELLS))).alias("step")
    seen = placed.select("*", steps)
    seen = seen.select(
        "node", "label", "size", "copies", "vector",
        F.least(F.col("cell"), F.col("cell") + F.col("step")).alias("low"),
        F.abs("step").alias("gap"), (F.col("step") < 0).alias("upper"),
    )
    keys = ["label", "size", "low", "gap"]
    parts = chunk_pairs(seen, keys, F.xxhash64("node"), CHUNK)
    # Of a pair of different cells all chunks of one meet all of the other; a row that plays the
    # lower part is in the left chunk there.
    where = [*keys, "left", "right"]
    dealt = parts.repartition(*where).sortWithinPartitions(*where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches, where, 1):
            values = [held.column(c).to_numpy() for c in where]
            new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
            bounds = [0, *new.tolist(), held.num_rows]
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                group = held.slice(start, stop - start)
                yield from _group(group, values[3][start], values[4][start], values[5][start])

    def _group(group: pa.Table, gap: int, left: int, right: int) -> Iterator[pa.RecordBatch]:
        chunk, upper = group.column("chunk").to_numpy(), group.column("upper").to_numpy()
        flat = group.column("vector").combine_chunks().flatten().to_numpy()
        vectors, copies = flat.reshape(group.num_rows, -1), group.column("copies").to_numpy()
        sides = [(chunk == left, chunk == right)]
        if gap:
            sides = [((chunk == left) & ~upper, (chunk == right) & upper)]
            if left != right:
                sides.append(((chunk == right) & ~upper, (chunk == left) & upper))
        for first, second in sides:
            count, labels = compare(vectors, copies, first, second, cosine)
            linked = np.flatnonzero(count)
            if len(linked):
                node = group.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(linked)), pa.array(count[linked]), node.take(pa.array(labels[linked]))], ["node", "links", "root"]
                )

    return dealt.select(*where, "chunk", "upper", "node", "copies", "vector").mapInArrow(run, "node string, links long, root string")
