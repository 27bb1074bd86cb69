"""Language identification by language-bitmask n-gram filters (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import keep

GRAM = 4  # characters, the blanks around words included
SLOT_BITS = 20  # of the filter: 2**20 slots with one bit per language
SAMPLE = 20_000  # labelled rows, about, that the filters are made from
SHARE = 0.01  # of a language's documents that an n-gram must occur in
UNKNOWN = "und"
SEGMENT = 1 << 20  # characters of a text looked at at once
# Odd multipliers of the n-gram hash and of its two slots.
MIX = np.uint64(0x9E3779B97F4A7C15)
FIRST, SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_letters = np.array([chr(c).isalpha() for c in range(1 << 16)])
# The character itself where it is a letter, else a blank.
_FOLD = np.where(_letters, np.arange(1 << 16), 32).astype(np.uint32)


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text in lower case, between two blanks, whose runs of other characters than letters are one blank.

    They come in parts of about ``SEGMENT``; the last characters of a part are carried into the next, so
    the parts together are the n-grams of the whole text.
    """
    text = f" {text.lower()} "
    codes = np.zeros(0, dtype=np.uint32)
    for start in range(0, len(text), SEGMENT):
        new = np.frombuffer(text[start : start + SEGMENT].encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = np.concatenate((codes, np.where(new < 1 << 16, _FOLD[np.minimum(new, (1 << 16) - 1)], new)))
        blank = codes == 32
        codes = codes[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]
        n = max(len(codes) - GRAM + 1, 0)
        value = np.zeros(n, dtype=np.uint64)
        for k in range(GRAM if n else 0):
            value = value * MIX + codes[k : k + n] + np.uint64(1)
        yield value ^ (value >> np.uint64(29))
        codes = codes[n:]


def slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - SLOT_BITS)
    return ((hashes * FIRST) >> shift).astype(np.int64), ((hashes * SECOND) >> shift).astype(np.int64)


@dataclass
class Filters:
    """Bloom filters of all languages, stored slot by slot: bit k of ``table[w, slot]`` belongs to language 64 w + k."""

    languages: list[str]
    table: np.ndarray

    def false_positives(self) -> np.ndarray:
        """Chance that an n-gram that was never put in passes, per language."""
        full = [np.count_nonzero(self.table[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(self.languages))]
        return (np.array(full, dtype=float) / self.table.shape[1]) ** 2

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Of how many n-grams each language's filter has both slots, and the number of n-grams."""
        found, total = np.zeros(len(self.languages), dtype=np.int64), 0
        for part in grams(text):
            one, two = slots(part)
            total += len(one)
            for w in range(len(self.table)):
                masks = self.table[w][one] & self.table[w][two]
                for k in range(64 * w, min(64 * w + 64, len(self.languages))):
                    found[k] += np.count_nonzero(masks & np.uint64(1 << (k % 64)))
        return found, total

    def decide(self, text: str | None, chance: np.ndarray) -> tuple[str, float]:
        """The language with the largest share of n-grams, false positives taken off, and its part of all shares."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        found, total = self.counts(text)
        shares = np.maximum(found / max(total, 1) - chance, 0) / np.maximum(1 - chance, 1e-9)
        best = int(shares.argmax())
        return self.languages[best], float(shares[best] / shares.sum()) if shares.sum() > 0 else 1 / len(shares)


def shares_of_sample(counted: dict[str, int], sample: int) -> dict[str, float]:
    """The part of each language's rows to draw: all of rare ones, and as many rows of each of the others, ``sample`` together."""
    left, quota = float(sample), 0.0
    for k, n in enumerate(sorted(counted.values())):
        quota = left / (len(counted) - k)
        left -= min(n, quota)
    return {name: min(1.0, quota / n) for name, n in counted.items()}


def fit(labelled: DataFrame, text: str, lang: str, stable: list[str], sample: int = SAMPLE, share: float = SHARE) -> Filters:
    """Filters from about ``sample`` rows of ``labelled`` (all of them if there are fewer), chosen by a hash of ``stable``.

    Each language gives equally many rows, or all it has, so that a rare one is learnt beside a frequent one.
    An n-gram goes into the filter of every language of whose sampled documents at least ``share`` contain it, so what
    is collected, at most one row per slot, does not grow with the data. Rows with a null text or language are left out.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), *stable)
    counted = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counted)
    words = max(1, -(-len(languages) // 64))
    table = np.zeros((words, 1 << SLOT_BITS), dtype=np.uint64)
    if not languages:
        return Filters([], table)
    below = [(name, round(part * (1 << 20))) for name, part in shares_of_sample(counted, sample).items()]
    below = F.broadcast(labelled.sparkSession.createDataFrame(below, "lang string, _below long"))  # one row per language
    chosen = rows.join(below, "lang").filter(F.pmod(F.xxhash64(*stable), F.lit(1 << 20)) < F.col("_below"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, name in zip(batch.column("text"), batch.column("lang"), strict=True):
                found = np.unique(np.concatenate(list(grams(value.as_py())))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(found), pa.string()), pa.array(found)], ["lang", "gram"])

    seen = chosen.select("text", "lang").mapInArrow(run, "lang string, gram long").groupBy("lang", "gram").count()
    sizes = chosen.groupBy("lang").agg(F.count("*").alias("docs"))
    often = seen.join(sizes, "lang").filter(F.col("count") >= F.greatest(F.lit(2), share * F.col("docs")))
    found = keep(often.select("lang", "gram"), "grams").toArrow()
    number = {name: k for k, name in enumerate(languages)}
    ids = np.array([number[name] for name in found.column("lang").to_pylist()], dtype=np.int64)
    hashes = found.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    for slot in slots(hashes):
        np.bitwise_or.at(table, (ids // 64, slot), np.uint64(1) << (ids % 64).astype(np.uint64))
    return Filters(languages, table)


def predict(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``.

    A text that is null or has no letter is ``und`` with score 0, as is everything if nothing was learned. Of languages with equal
    shares the first by name is taken; a text of which no n-gram is known gets it too, with one nth of n languages as its score. Each row is judged by its
    text alone, the whole of it; columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop(*[c for c in ("lang_pred", "score") if c != text])
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    sent = docs.sparkSession.sparkContext.broadcast((filters, filters.false_positives()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chance = sent.value
        for batch in batches:
            made = [known.decide(t.as_py(), chance) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                [*others, "lang_pred", "score"],
            )

    return docs.select(*others, text).mapInArrow(run, schema)


def fold(id_column: str | Column, folds: int) -> Column:
    """CRC-32 of an id as text, modulo ``folds`` (null id: of the empty text)."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds
