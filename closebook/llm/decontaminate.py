"""Benchmark decontamination by broadcast n-gram sets (operator 9)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from closebook.llm.common import LOWER, keep

WINDOW = 10
BLOCK_BYTES = 16 << 20  # of benchmark text whose windows are broadcast at once
# The characters that are no part of a word, as bytes; all others are kept.
BLANK = bytes(0x20 if b < 0x30 or 0x3A <= b < 0x61 or 0x7B <= b < 0x80 else b for b in range(256))
FOLD = bytes(BLANK[b] for b in LOWER)
WORD = re.compile(rb"[^ ]+")
SEGMENT = 1 << 20  # bytes of a text that are looked at once


class Windows:
    """All windows of some items: their hashes in order, one place of each for verification, and the items that hold it.

    The items' words are numbers in one long array; a window is a place in it, so nothing is stored per word of a window.
    """

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        number = self.vocabulary.setdefault
        parts = [
            np.fromiter((number(w, len(self.vocabulary)) for w in text.encode("utf-8", "replace").translate(FOLD).split()), np.int32)
            for _, text in items
        ]
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        self.words = np.concatenate([*parts, np.zeros(0, np.int32)])
        sizes = np.minimum(lengths, window)
        self.by_size = {}
        for size in np.unique(sizes[sizes > 0]).tolist():
            holders = np.flatnonzero(sizes == size)
            counts = lengths[holders] - size + 1
            owners = np.repeat(holders, counts)
            places = np.arange(counts.sum()) + np.repeat(begins[holders] - (np.cumsum(counts) - counts), counts)
            self.by_size[size] = self._distinct(size, places, owners)

    def _hashes(self, numbers: np.ndarray, places: np.ndarray, powers: np.ndarray) -> np.ndarray:
        value = np.zeros(len(places), dtype=np.uint64)
        for k, power in enumerate(powers):
            value += (numbers[places + k].astype(np.uint64) + np.uint64(1)) * power
        return value

    def _distinct(self, size: int, places: np.ndarray, owners: np.ndarray) -> tuple:
        """Powers, distinct hashes in order, a place of each window, and its items as runs of ``owners``."""
        multiplier = 0x9E3779B97F4A7C15
        while True:  # another multiplier if two windows share a hash
            powers = np.array([pow(multiplier, k + 1, 1 << 64) for k in range(size)], dtype=np.uint64)
            hashes = self._hashes(self.words, places, powers)
            order = np.lexsort((owners, hashes))
            hashes, at, held = hashes[order], places[order], owners[order]
            same = hashes[1:] == hashes[:-1]
            pairs = np.flatnonzero(same)
            if all((self.words[at[pairs] + k] == self.words[at[pairs + 1] + k]).all() for k in range(size)):
                break
            multiplier += 2
        fresh = np.concatenate(([True], ~same))
        once = fresh | np.concatenate(([True], held[1:] != held[:-1]))  # an item may repeat a window
        starts = np.cumsum(once)[fresh] - 1
        return powers, hashes[fresh], at[fresh], np.append(starts, once.sum()), held[once]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in an occurrence of a window, and the items with one."""
        get = self.vocabulary.get
        ids = np.fromiter(map(get, words, repeat(-1)), dtype=np.int32, count=len(words))
        marked = np.zeros(len(words) + 1, dtype=np.int32)
        items: set = set()
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        for size, (powers, hashes, places, bounds, owners) in self.by_size.items():
            if len(words) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            value = self._hashes(ids, starts, powers)
            at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            same = hashes[at] == value
            starts, at = starts[same], at[same]
            for k in range(size):
                same = ids[starts + k] == self.words[places[at] + k]
                starts, at = starts[same], at[same]
            np.add.at(marked, starts, 1)
            np.add.at(marked, starts + size, -1)
            for k in np.unique(at).tolist():
                items.update(self.items[i] for i in owners[bounds[k] : bounds[k + 1]].tolist())
        return np.cumsum(marked[:-1]) > 0, items


def scan(text: str | None, windows: Windows) -> tuple[int, list[tuple[int, int]], list]:
    """Number of words, runs of hit words (first, end) and the items found, of a whole text."""
    data = (text or "").encode("utf-8", "replace").translate(FOLD)
    runs: list[tuple[int, int]] = []
    items: set = set()
    kept: list[bytes] = []
    total = start = 0
    while start < len(data):
        stop = min(start + SEGMENT, len(data))
        while stop < len(data) and data[stop] != 0x20:
            stop += 1
        fresh = data[start:stop].split()
        words = kept + fresh
        hit, found = windows.hits(words)
        items |= found
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))) + (total - len(kept))
        runs += [(first, end) for first, end in edges.reshape(-1, 2).tolist()]
        total += len(fresh)
        kept = words[max(len(words) - windows.window + 1, 0) :] if windows.window > 1 else []
        start = stop
    return total, merged(runs), sorted(items, key=str)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint runs in order."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str) -> list[Callable[[], list[tuple[object, str]]]]:
    """Parts of the benchmark, each of about ``BLOCK_BYTES`` of text."""
    narrow = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES) or 1
    if n > 1:
        narrow = keep(narrow.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "benchmark")
        return [lambda k=k: [tuple(r) for r in narrow.filter(F.col("block") == k).drop("block").collect()] for k in range(n)]
    return [lambda: [tuple(r) for r in narrow.collect()]]


RESULT = "struct<n_words: bigint, spans: array<struct<first: bigint, end: bigint>>, items: array<{}>>"


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW,
    name: str = "contamination",
) -> DataFrame:
    """The columns of ``docs`` and ``contamination`` (or another ``name``): number of words, hit runs of words and items found.

    A window is ``window`` consecutive words of an item, or the whole of a shorter item that has
    words. A run is (first, end), end exclusive, in words; runs are disjoint and in order. Null
    texts have no words; items with a null text or without words have no windows, and a null item
    id marks words but is not listed. An empty benchmark finds nothing, an empty table of documents
    gives an empty result. Rows are taken one by one, so repeats each get their result. A column of
    ``docs`` with that name is replaced.

    The windows of about ``BLOCK_BYTES`` of items are broadcast at once, so the sum of the items'
    lengths is looked at first; a larger benchmark is taken in several such blocks, and what one
    block has found is written before the next is broadcast. Repeated items are taken once.
    """
    found = docs.drop(name)
    columns = found.columns
    kind = benchmark.schema[item].dataType
    result = RESULT.format(kind.simpleString())
    schema = found.withColumn(name, F.lit(None).cast(result)).schema
    result_type = schema[name].dataType
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item, item_text)
    for number, load in enumerate(blocks):
        sent = spark.sparkContext.broadcast(Windows(load(), window))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, number=number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = []
                before = batch.column(name).to_pylist() if number else repeat(None)
                for value, old in zip(batch.column(text), before, strict=False):
                    words, runs, items = scan(value.as_py(), sent.value)
                    items = [i for i in items if i is not None]
                    if old:
                        runs = merged(runs + [(s["first"], s["end"]) for s in old["spans"]])
                        items = sorted({*items, *old["items"]}, key=str)
                    made.append({"n_words": words, "spans": [{"first": a, "end": b} for a, b in runs], "items": items})
                kept = pa.array(made, to_arrow_type(result_type))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), kept], [*columns, name])

        found = found.select(*columns, *([name] if number else [])).mapInArrow(run, schema)
        if number + 1 < len(blocks):
            found = keep(found, name)
            sent.unpersist()
    return found


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])


def remove(found: DataFrame, text: str = "text", share: float = 0.2, name: str = "contamination") -> DataFrame:
    """Clean documents unchanged, slightly contaminated ones without their hit words, the rest dropped.

    ``found`` comes from :func:`find`. A document of which more than ``share`` of the words are hit
    goes; otherwise every run of hit words is cut out together with the separators inside it. The
    columns are those of ``found`` without that of :func:`find`. A null text stays null.
    """
    columns = [c for c in found.columns if c != name]
    spans = F.col(f"`{name}`.spans")
    hit, words = n_hit(spans), F.col(f"`{name}`.n_words")
    kept = found.filter(hit <= words * share)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        made = [without(t, [(int(x["first"]), int(x["end"])) for x in s]) for t, s in zip(texts, spans, strict=True)]
        return pd.Series(made, dtype=object)

    clean = F.when(F.size(spans) == 0, F.col(text)).otherwise(cut(F.col(text), spans))
    return kept.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in columns])


def without(text: str | None, runs: list[tuple[int, int]]) -> str | None:
    """A text without some runs of its words."""
    if text is None or not runs:
        return text
    data = text.encode("utf-8", "replace")
    parts, wanted, last, opened = [], iter(runs), 0, 0
    run = next(wanted, None)
    for k, word in enumerate(WORD.finditer(data.translate(FOLD))):
        if run and k == run[0]:
            opened = word.start()
        if run and k == run[1] - 1:
            parts.append(data[last:opened])
            last = word.end()
            run = next(wanted, None)
    return b"".join([*parts, data[last:]]).decode("utf-8", "replace")
