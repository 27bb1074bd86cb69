"""SimHash near-duplicates by bit-sliced comparison (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import LOWER, groups, keep
from closebook.llm.components import components

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
CHUNK = 1024  # members of a bucket that one task compares with as many others
BUCKET = 512  # rows wanted in a bucket of evenly spread fingerprints
SEGMENT = 1 << 20  # bytes of a text that are split into words at once
SLAB = 1 << 15  # words of 64 comparisons held at once
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
LANE = np.uint64(0x0101010101010101)


# Fingerprints.


def word_runs(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text, segment by segment; each repeats the last ``overlap`` words before it."""
    kept: list[bytes] = []
    start = 0
    while start < len(text):
        stop = min(start + SEGMENT, len(text))
        while stop < len(text) and not text[stop : stop + 1].isspace():
            stop += 1
        words = kept + text[start:stop].translate(LOWER).split()
        yield words
        kept = words[max(len(words) - overlap, 0) :] if overlap else []
        start = stop


def _bit_counts(digests: bytes) -> np.ndarray:
    """How often each of the 64 bits is set in big-endian hashes, from the lowest bit."""
    hashes = np.frombuffer(digests, dtype=">u8").astype(np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    starts = np.arange(0, len(hashes), 255)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & LANE, starts)  # eight counters of 8 bits
        counts[bit::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text (0 without words)."""
    digest, counts, total = xxhash.xxh64_digest, np.zeros(BITS, dtype=np.int64), 0
    words: list[bytes] = []
    for words in word_runs((text or "").encode("utf-8", "replace"), shingle - 1):
        n = len(words) - shingle + 1
        if n < 1:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        first = np.concatenate(([0], ends[:-1]))[:n].tolist()
        last = (ends[shingle - 1 :] - 1).tolist()
        counts += _bit_counts(b"".join([digest(joined[i:j], SEED) for i, j in zip(first, last, strict=True)]))
        total += n
    if not total:
        if not words:
            return 0
        counts, total = _bit_counts(digest(b" ".join(words), SEED)), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``docs`` and ``fp``, the fingerprint of the text as a signed long.

    A null or blank text has fingerprint zero. A text of fewer words than a shingle is one shingle.
    """
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(text)), np.uint64, batch.num_rows
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(made)], [*others, "fp"])

    return docs.select(*others, text).mapInArrow(run, schema)


# Comparison.


def _exceeded(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, equal = np.zeros_like(over), np.full_like(over, FULL)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above = above | (equal & counters[k])
            equal = equal & ~counters[k]
    return above | over


def close_words(
    planes: np.ndarray, masks: np.ndarray, query: np.ndarray, word: np.ndarray, dead: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of 64 candidates lie within the radius of a query, for many (query, word) pairs.

    ``planes[p, w]`` has bit p of the 64 candidates of word w, ``masks[p, q]`` is all ones where
    bit p of query q is set. ``dead`` marks lanes that are not to be compared. Mismatches are
    added, two planes at a time, to vertical counters by carry-save adders; pairs all of whose
    lanes exceed the radius are abandoned after every eighth plane. Returns the pairs left, and
    their matching lanes.
    """
    counters = [np.zeros_like(dead) for _ in range(max(1, radius.bit_length()))]
    over = dead
    for plane in range(0, BITS, 2):
        x = planes[plane][word] ^ masks[plane][query]
        y = planes[plane + 1][word] ^ masks[plane + 1][query]
        low = counters[0]
        half = x ^ y
        carry = (x & y) | (half & low)
        counters[0] = half ^ low
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over = over | carry
        if plane % 8 == 6:
            left = np.flatnonzero(_exceeded(counters, over, radius) != FULL)
            if not len(left):
                return query[:0], word[:0], dead[:0]
            if len(left) < len(query):
                query, word, over = query[left], word[left], over[left]
                counters = [c[left] for c in counters]
    return query, word, ~_exceeded(counters, over, radius)


def spread(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest connected index so far) after the links a-b are added."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, labels):
            return labels
        labels = new


def forest(group: np.ndarray, fp: np.ndarray, first: np.ndarray, second: np.ndarray, radius: int) -> np.ndarray:
    """For each row the smallest row that it is linked with, within its group, directly or not.

    Rows of a group (adjacent) with ``first`` are compared with those with ``second``; rows that
    have both, with one another once.
    """
    labels = np.arange(len(fp))
    candidate = np.flatnonzero(second)
    queries = np.flatnonzero(first)
    if not len(candidate) or not len(queries):
        return labels
    # Candidates of a group fill whole words; the rest of the last word is dead.
    size = np.bincount(group[candidate], minlength=group[-1] + 1)
    words_of = -(-size // BITS)
    base = np.concatenate(([0], np.cumsum(words_of)))
    rank = np.arange(len(candidate)) - np.concatenate(([0], np.cumsum(size)))[group[candidate]]
    lane_row = np.full(base[-1] * BITS, -1)
    lane_row[base[group[candidate]] * BITS + rank] = candidate
    lane_fp = np.where(lane_row >= 0, fp[lane_row], 0)
    one = np.uint64(1)
    planes = np.stack([np.packbits(((lane_fp >> np.uint64(p)) & one).astype(np.uint8), bitorder="little").view("<u8") for p in range(BITS)])
    empty = np.packbits(lane_row < 0, bitorder="little").view("<u8")
    masks = np.stack([np.uint64(0) - ((fp[queries] >> np.uint64(p)) & one) for p in range(BITS)])
    lane_row = lane_row.reshape(-1, BITS)
    # A query meets the words of its group that have a later row.
    top = lane_row.max(axis=1)
    where = np.arange(len(queries))
    count = words_of[group[queries]]
    done = 0
    ends = np.cumsum(count)
    while done < len(queries):
        stop = max(done + 1, np.searchsorted(ends, (ends[done - 1] if done else 0) + SLAB))
        n = count[done:stop]
        query = np.repeat(where[done:stop], n)
        word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(base[group[queries[done:stop]]], n)
        both = second[queries[query]]
        useful = ~both | (top[word] > queries[query])
        query, word = query[useful], word[useful]
        query, word, hit = close_words(planes, masks, query, word, empty[word], radius)
        some = np.flatnonzero(hit)
        if len(some):
            query, word, hit = query[some], word[some], hit[some]
            # Most hits of a large group lie in its largest set so far: one link each will do there.
            main = np.bincount(labels).argmax()
            inside = np.packbits((lane_row[word] >= 0) & (labels[lane_row[word]] == main), axis=1, bitorder="little").view("<u8").ravel()
            known = np.flatnonzero(hit & inside)
            bits = np.unpackbits((hit & ~inside).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(bits)
            a = np.concatenate((queries[query[known]], queries[query[pair]]))
            b = np.concatenate((np.full(len(known), main), lane_row[word[pair], lane]))
            labels = spread(labels, a, b)
        done = stop
    return labels


def _band_masks(rows: int, radius: int) -> list[int]:
    """Masks of which every pair within the radius agrees on one.

    The 64 bits are cut into radius + t bands, of which at most ``radius`` differ, so t agree. The
    more rows there are the larger t is chosen; any choice finds all pairs.
    """
    together = 1
    while 2.0 ** (BITS * together // (radius + together)) < rows / BUCKET:
        together += 1
    bands = radius + together
    edges = [BITS * k // bands for k in range(bands + 1)]
    parts = [((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in range(bands)]
    return [sum(chosen) for chosen in combinations(parts, together)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def chunk_pairs(rows: DataFrame, keys: list[str], spread_by: Column, size: int) -> DataFrame:
    """Rows repeated once for every pair of chunks of their group that they belong to.

    A group of at most ``size`` rows is one chunk, larger ones are dealt into equal chunks by a hash.
    Adds ``chunk``, ``left`` and ``right`` (left <= right); the rows of one (keys, left, right)
    are to be compared together, so a group of any size becomes tasks of bounded size.
    """
    large = keep(rows.groupBy(*keys).count().filter(F.col("count") > size), "large")
    n = F.coalesce(F.ceil(F.col("count") / size), F.lit(1)).cast("int")
    dealt = rows.join(large, keys, "left").withColumn("n", n).withColumn("chunk", F.pmod(spread_by, "n").cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return dealt.select(
        *rows.columns, "chunk", F.least("chunk", "met").alias("left"), F.greatest("chunk", "met").alias("right")
    )


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a`` and ``b``: pairs of the distinct longs in ``fp`` that connect all those within the radius.

    Every pair of fingerprints that differ in at most ``radius`` bits is compared; of the links of
    one task only as many are returned as its connected sets need. No pair is lost through size.
    """
    distinct = keep(fps.select("fp").distinct(), "fps")
    masks = _band_masks(distinct.count(), radius)
    keys = F.array(*[F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)])
    rows = distinct.select("fp", F.inline(keys))
    parts = chunk_pairs(rows, ["band", "key"], F.xxhash64("fp"), CHUNK)
    columns = ["band", "key", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches, columns, 1 << 16):
            values = [held.column(c).to_numpy() for c in columns]
            new = np.any([v[1:] != v[:-1] for v in values], axis=0)
            group = np.concatenate(([0], np.cumsum(new)))
            fp = held.column("fp").to_numpy().view(np.uint64)
            chunk = held.column("chunk").to_numpy()
            labels = forest(group, fp, chunk == values[2], chunk == values[3], radius)
            linked = np.flatnonzero(labels != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[linked].view(np.int64)), pa.array(fp[labels[linked]].view(np.int64))], ["a", "b"]
            )

    dealt = parts.repartition(*columns).sortWithinPartitions(*columns)
    return dealt.select(*columns, "chunk", "fp").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` (long) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id of any document reachable over links of at most
    ``radius`` differing bits. Other columns are ignored. Rows that repeat an id or a text each
    give one row; a null id never is a component's id unless no member has another. Texts without
    words share fingerprint zero and so are one group, with whatever is within the radius of zero.
    An empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    fps = keep(fingerprints(narrow, "text", shingle), "fingerprints")
    groups_of = with_components(fps, radius)
    return fps.join(groups_of, "fp").select("doc_id", "fp", "component_id")


def with_components(fps: DataFrame, radius: int) -> DataFrame:
    """``fp``, ``root`` (which names its component) and ``component_id`` (smallest doc_id) of every distinct fingerprint."""
    nodes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(fps, radius), "a", "b").withColumnRenamed("node", "fp")
    nodes = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    nodes = keep(nodes.select("fp", "least", "root"), "roots")
    least = keep(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    return keep(nodes.join(least, "root").select("fp", "root", "component_id"), "groups")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The columns of ``docs``, and of each component of :func:`near_duplicates` one row.

    It is the one with the smallest id (null last), and among rows with that id the one with the
    smallest hash of all columns; of rows that are equal throughout one stays. An empty table gives an empty result.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    maps = {f.name for f in docs.schema if "map<" in f.dataType.simpleString()}  # have no hash
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`") for c in docs.columns])
    hashed = docs.select(F.struct(*columns).alias("_doc"), F.col(id_column).alias("_own"), row.alias("_hash"))
    narrow = docs.select(F.col(id_column).alias("doc_id"), row.alias("row"), F.col(text).alias("text"))
    fps = keep(fingerprints(narrow, "text", shingle), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = fps.join(with_components(fps, radius), "fp").groupBy("root").agg(F.min(order).alias("first"))
    winners = keep(first.select(F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row")), "kept")
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_row"))
    found = hashed.join(winners, same, "left_semi")
    if not fps.groupBy("doc_id", "row").count().filter("count > 1").isEmpty():
        found = found.dropDuplicates(["_own", "_hash"])
    return found.select("_doc.*")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
