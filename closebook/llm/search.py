"""Ranked lexical search by an Aho-Corasick scan of the documents (operator 13)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import floor, log

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from closebook.llm.common import keep
from closebook.llm.decontaminate import FOLD

TOP = 50
BLOCK_BYTES = 2 << 20  # of item terms whose automaton is broadcast at once
SEGMENT = 1 << 20  # bytes of a text that are looked at once
CELLS = 1 << 20  # document-item pairs, and terms of items in documents, that are scored at once
SPREAD = 16  # parts that an item's candidates are ranked in first
# Fixed values of the ranking: scale of weights and shares, and of the saturation by tf and length.
WEIGHT, SHARE, TF, LENGTH, SLOPE = 1000, 1_000_000_000, 1000, 20, 50
LIMIT = 1 << 62  # beyond it, numbers go through Python's integers


def parts(text: str | None) -> Iterator[str]:
    """The terms of a text, lower-case and each with one blank around it, in pieces of bounded size.

    What is no part of a term becomes a blank, and runs of blanks become one, so a term between two
    blanks is a maximal match and never a part of a longer one. Pieces are cut between terms.
    """
    data = (text or "").encode("utf-8", "replace").translate(FOLD)
    start = 0
    while start < len(data):
        stop = min(start + SEGMENT, len(data))
        while stop < len(data) and data[stop] != 0x20:
            stop += 1
        terms = data[start:stop].split()
        if terms:
            yield f" {b' '.join(terms).decode('utf-8', 'replace')} "
        start = stop


def terms_of(text: str | None) -> set[str]:
    return {term for part in parts(text) for term in part.split(" ") if term}


@dataclass
class Scanner:
    """An automaton of terms with a blank on either side; its outputs are the terms' numbers."""

    terms: list[str]

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term} ", number)
        made.make_automaton()
        return made

    def __getstate__(self) -> dict:
        return {"terms": self.terms}  # every worker builds its own automaton

    def count(self, text: str | None) -> tuple[int, Counter]:
        """Number of all terms of a text, and how often each known one occurs."""
        total, found = 0, Counter()
        for part in parts(text):
            total += part.count(" ") - 1
            if self.terms:
                found.update(number for _, number in self.automaton.iter(part))
        return total, found


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``item`` and ``term``; rows that share an item are one item with the terms of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, value in enumerate(batch.column("text")):
                found = sorted(terms_of(value.as_py()))
                if found:
                    same = batch.column("item").take(pa.array([k] * len(found)))
                    yield pa.RecordBatch.from_arrays([same, pa.array(found, pa.string())], ["item", "term"])

    rows = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    schema = rows.select("item").withColumn("term", F.lit("")).schema
    return rows.mapInArrow(run, schema).distinct()


def _blocks(found: DataFrame) -> list[DataFrame]:
    """Items with their terms in blocks of about ``BLOCK_BYTES``; the sum of their bytes is looked at first."""
    total = found.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    return [found.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k) if n > 1 else found for k in range(n)]


def counts(docs: DataFrame, scanner: Scanner, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``n`` (its terms with repeats) and ``found`` (number and frequency of the scanner's terms in it) of every row."""
    rows = docs.select(F.col(id_column).alias("doc"), F.col(text).cast("string").alias("text"))
    pair = "array<struct<term: int, tf: bigint>>"
    schema = rows.select("doc").withColumn("n", F.lit(0).cast("long")).withColumn("found", F.lit(None).cast(pair)).schema
    sent = docs.sparkSession.sparkContext.broadcast(scanner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = sent.value
        for batch in batches:
            totals, numbers, often, ends = [], [], [], [0]
            for value in batch.column("text"):
                total, found = scan.count(value.as_py())
                totals.append(total)
                numbers += found.keys()
                often += found.values()
                ends.append(len(numbers))
            pairs = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(often, pa.int64())], ["term", "tf"])
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(totals, pa.int64()), listed], ["doc", "n", "found"])

    return rows.mapInArrow(run, schema)


@dataclass
class Ranking:
    """Weights of terms, the items each belongs to (in one list, cut at ``bounds``), and the corpus's counts."""

    weights: np.ndarray
    bounds: np.ndarray
    owners: np.ndarray
    items: int
    docs: int  # with at least one term
    length: int  # of all documents together, in terms

    def together(self, found: pa.ListArray) -> int:
        """How many of the next documents can be scored at once: one at least."""
        ends = np.cumsum(pc.list_value_length(found).to_numpy())
        work = np.concatenate(([0], np.cumsum(np.diff(self.bounds)[found.flatten().field("term").to_numpy()])))[ends]
        work = work + self.items * np.arange(1, len(ends) + 1)
        return max(1, int(np.searchsorted(work, CELLS, "right")))

    def scores(self, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Score of every document (row) for every item (column); exact integers."""
        kind = np.int64 if int(n.max(initial=0)) * SLOPE * self.docs < LIMIT else object
        middle = 100 - SLOPE + (SLOPE * n.astype(kind) * self.docs) // max(self.length, 1)
        row = np.repeat(np.arange(len(n)), np.diff(ends))
        kind = np.int64 if middle.dtype != object and int(tf.max(initial=0)) * SHARE < LIMIT else object
        share = (SHARE * tf.astype(kind)) // (TF * tf.astype(kind) + LENGTH * middle[row].astype(kind))
        value = self.weights[term] * share.astype(np.int64)
        several = np.diff(self.bounds)[term]
        place = np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several) + np.repeat(self.bounds[term], several)
        out = np.zeros(len(n) * self.items, dtype=np.int64)
        np.add.at(out, np.repeat(row, several) * self.items + self.owners[place], np.repeat(value, several))
        return out.reshape(len(n), self.items)


def _best(held: pa.Table, top: int) -> pa.Table:
    """Per item the ``top`` rows with the highest score, of equal ones those with the smallest document (null last)."""
    held = held.sort_by([("item", "ascending"), ("score", "descending"), ("doc", "ascending")])
    item = held.column("item").to_numpy()
    first = np.concatenate(([True], item[1:] != item[:-1])) if len(item) else np.zeros(0, dtype=bool)
    place = np.arange(len(item)) - np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(item))))
    return held.filter(pa.array(place < top))


def _candidates(counted: DataFrame, ranking: Ranking, top: int) -> DataFrame:
    """``item`` (its number), ``doc`` and ``score``: of every task the ``top`` best documents of each item."""
    schema = counted.select(F.lit(0).alias("item"), "doc", F.lit(0).cast("long").alias("score")).schema
    kind = to_arrow_type(schema["doc"].dataType)
    shape = pa.schema([("item", pa.int32()), ("doc", kind), ("score", pa.int64())])
    sent = counted.sparkSession.sparkContext.broadcast(ranking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        least = np.ones(known.items, dtype=np.int64)  # a score that still can be among the best
        held, most = shape.empty_table(), 2 * top * known.items + CELLS // 4
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, known.together(batch.column("found").slice(start)))
                start += part.num_rows
                listed, n = part.column("found"), part.column("n").to_numpy()
                pairs = listed.flatten()
                ends = np.concatenate(([0], np.cumsum(pc.list_value_length(listed).to_numpy())))
                scores = known.scores(n, ends, pairs.field("term").to_numpy(), pairs.field("tf").to_numpy())
                row, item = np.nonzero(scores >= least)
                if not len(row):
                    continue
                new = [pa.array(item, pa.int32()), part.column("doc").take(pa.array(row)), pa.array(scores[row, item])]
                held = pa.concat_tables([held, pa.Table.from_arrays(new, schema=shape)])
                if held.num_rows > most:
                    held = _best(held, top)
                    full = np.bincount(held.column("item").to_numpy(), minlength=known.items) >= top
                    lowest = np.full(known.items, np.iinfo(np.int64).max)
                    np.minimum.at(lowest, held.column("item").to_numpy(), held.column("score").to_numpy())
                    least = np.where(full, lowest, 1)
        yield from _best(held, top).to_batches()

    return counted.mapInArrow(run, schema)


def _weight(docs: int, holding: int) -> int:
    return floor(WEIGHT * log((2 * docs + 2) / (2 * holding + 1)))


def _ranked(docs: DataFrame, block: DataFrame, id_column: str, text: str, top: int) -> DataFrame:
    """``item``, ``rank``, ``doc`` and ``score`` for the items of one block."""
    spark = docs.sparkSession
    pairs = block.toArrow()  # bounded by the block
    terms = sorted(set(pairs.column("term").to_pylist()))
    number = {term: k for k, term in enumerate(terms)}
    names = pc.unique(pairs.column("item"))
    place = pc.index_in(pairs.column("item"), names).to_numpy()
    of_term = np.array([number[t] for t in pairs.column("term").to_pylist()], dtype=np.int64)
    order = np.lexsort((place, of_term))
    bounds = np.concatenate(([0], np.cumsum(np.bincount(of_term, minlength=len(terms)))))

    counted = keep(counts(docs, Scanner(terms), id_column, text), "term-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    holding = counted.select(F.explode("found.term").alias("term")).groupBy("term").count().toArrow()  # one row per term of the block
    df = dict(zip(holding.column("term").to_pylist(), holding.column("count").to_pylist(), strict=True))
    weights = np.array([_weight(total["docs"], df.get(k, 0)) for k in range(len(terms))], dtype=np.int64)
    ranking = Ranking(weights, bounds, place[order].astype(np.int64), len(names), total["docs"], total["length"])

    best = _candidates(counted.filter(F.size("found") > 0), ranking, top)
    best = best.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(SPREAD)))
    down = [F.desc("score"), F.asc_nulls_last("doc")]
    inside = F.row_number().over(Window.partitionBy("item", "part").orderBy(*down))
    best = best.withColumn("rank", inside).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*down))).filter(F.col("rank") <= top)
    listed = spark.createDataFrame(pa.table({"number": pa.array(range(len(names)), pa.int32()), "name": names}))
    listed = listed.select("number", F.col("name").cast(block.schema["item"].dataType).alias("name"))
    named = best.join(F.broadcast(listed), F.col("item") == F.col("number"))  # one row per item of the block
    return named.select(F.col("name").alias("item"), "rank", "doc", "score")


def rank(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``top`` best documents of every item.

    Terms are the runs of letters, digits and characters beyond ASCII of a whole text, with A-Z
    lower-cased. A document's score for an item sums, over the item's distinct terms, the term's
    inverse document frequency times a saturating share of its frequency, all in integers; only
    scores above 0 are listed, equal ones in order of the document's id (null last).

    The documents are scanned once per block of items by an automaton of the block's terms, which
    counts frequencies straight from the text; the counts are stored, as document frequencies have to be known before scores. Blocks hold about
    ``BLOCK_BYTES`` of terms, however many items there are; a single item's terms stay together.
    Each task keeps the best documents per item, and those are ranked in parts before they meet.

    Null and empty texts have no terms: such documents are never listed and do not count, such
    items give no row. Items that share an id (null is one) are one item. Rows of ``docs`` that
    repeat an id are documents of their own, each listed. Other columns are ignored; empty
    tables give an empty result.
    """
    found = keep(item_terms(items, item, item_text), "item-terms")
    kinds = found.select("item").schema, docs.select(F.col(id_column).alias("doc")).schema
    result = None
    for block in _blocks(found):
        made = keep(_ranked(docs, block, id_column, text, top), "ranked")
        result = made if result is None else result.unionByName(made)
    if result is None:
        shape = f"item {kinds[0][0].dataType.simpleString()}, rank int, doc {kinds[1][0].dataType.simpleString()}, score long"
        result = docs.sparkSession.createDataFrame([], shape)
    return result.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")
