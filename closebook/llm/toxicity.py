"""Toxicity by a linear-chain conditional random field over words (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import keep
from closebook.llm.decontaminate import FOLD, WORD

SAMPLE = 12_000  # labelled documents, about, that the field is fitted to
PRECISION = 0.9  # of a word's documents, and of its surroundings, that must be toxic before it may be labelled so
SUPPORT = 3  # toxic documents that a word must be in
SURROUNDINGS = 8  # different pairs of neighbours that a word must have in toxic documents
PIECE = 32  # words of a training sequence
STEPS = 300
PENALTY = 0.05
REJECT = 0.7
SEGMENT = 1 << 20  # bytes of a text that are split into words at once


@dataclass
class Field:
    """States: clean (0) and toxic (1).

    The score of a state sequence sums, for toxic words, a weight per known word, weights for a
    known word just before or after and a bias, and a weight for each pair of states.
    """

    words: list[bytes]
    emit: np.ndarray  # bias, word before, word after, then one weight per word
    move: np.ndarray  # 2 x 2
    number: dict[bytes, int] = field(init=False)

    def __post_init__(self) -> None:
        self.number = {w: k + 1 for k, w in enumerate(self.words)}

    def toxic_scores(self, ids: np.ndarray) -> np.ndarray:
        """Score of the toxic state at each place; rows are sequences of word numbers (0: unknown, -1: after the end)."""
        known = np.zeros((ids.shape[0], ids.shape[1] + 2))
        known[:, 1:-1] = ids > 0
        by_word = np.concatenate(([0.0], self.emit[3:]))[np.maximum(ids, 0)]
        return self.emit[0] + self.emit[1] * known[:, :-2] + self.emit[2] * known[:, 2:] + by_word

    def forward_backward(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of the toxic state, expected numbers of each pair of states, and the log partition functions.

        Places after the end of a sequence have no state, so they add nothing to any of these.
        """
        real = ids >= 0
        scores = np.stack([np.zeros(ids.shape), self.toxic_scores(ids)], axis=2)
        n, length, _ = scores.shape
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, length):
            reached = np.logaddexp(ahead[:, t - 1, :1] + self.move[0], ahead[:, t - 1, 1:] + self.move[1]) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], reached, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            after = back[:, t + 1] + scores[:, t + 1]
            left = np.logaddexp(after[:, :1] + self.move[:, 0], after[:, 1:] + self.move[:, 1])
            back[:, t] = np.where(real[:, t + 1, None], left, 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        marginal = np.where(real, np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None]), 0.0)
        pairs = np.empty((n, 2, 2))
        for i in range(2):
            for j in range(2):
                joint = ahead[:, :-1, i] + self.move[i, j] + scores[:, 1:, j] + back[:, 1:, j] - total[:, None]
                pairs[:, i, j] = np.where(real[:, 1:], np.exp(joint), 0.0).sum(axis=1)
        return marginal, pairs, total

    def known_words(self, ids: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Chance that a known word of a chain is toxic, the places of known words and of those beside them, and their toxic marginals.

        All are exact for the whole chain. Elsewhere every word multiplies the same 2 x 2 matrix, so the words between two
        places are a power of it. The chance compares the chain with the one whose known words must be clean. Unknown words
        may be in either state in both, so a text is not the more toxic for being long.
        """
        hit = np.flatnonzero(ids > 0)
        if not len(hit):
            return 0.0, hit, np.zeros(0)
        places = np.unique(np.concatenate((hit - 1, hit, hit + 1)))
        places = places[(places >= 0) & (places < len(ids))]
        known = np.pad(ids > 0, 1)
        by_word = np.concatenate(([0.0], self.emit[3:]))[ids[places]]
        toxic = np.exp(self.emit[0] + self.emit[1] * known[places] + self.emit[2] * known[places + 2] + by_word)
        clean_only = np.where(ids[places] > 0, 0.0, toxic)
        start = np.array([1.0, np.exp(self.emit[0])])
        pair = np.exp(self.move)
        root, vectors = np.linalg.eig(pair * start)  # of positive entries, so both are real and differ
        root, inverse = root / root.max(), np.linalg.inv(vectors)

        def power(exponents: np.ndarray) -> np.ndarray:
            return np.maximum(np.einsum("ij,kj,jl->kil", vectors, root ** exponents[:, None].astype(float), inverse), 0)

        steps = power(np.diff(places) - 1) @ pair
        tail = power(np.array([len(ids) - 1 - places[-1]]))[0].sum(axis=1)
        first = start @ power(places[:1] - 1)[0] @ pair if places[0] else np.ones(2)

        flat = steps.reshape(-1, 4).tolist()

        def ahead(weights: np.ndarray) -> tuple[list[float], float]:
            """The toxic part of the forward sums at each place, and the logarithm of the sum over all state sequences."""
            x, y = float(first[0]), float(first[1] * weights[0])
            total = np.log(x + y)
            x, y = x / (x + y), y / (x + y)
            parts, sizes = [y], []
            for (a, b, c, d), w in zip(flat, weights[1:].tolist(), strict=True):
                x, y = x * a + y * c, (x * b + y * d) * w
                size = x + y
                x, y = x / size, y / size
                parts.append(y)
                sizes.append(size)
            return parts, float(total + np.log(sizes).sum() + np.log(x * tail[0] + y * tail[1]))

        parts, whole = ahead(toxic)
        clean = ahead(clean_only)[1]
        x, y = tail.tolist()
        later = [y / (x + y)]
        for (a, b, c, d), w in zip(reversed(flat), reversed(toxic[1:].tolist()), strict=True):
            x, y = a * x + b * w * y, c * x + d * w * y
            x, y = x / (x + y), y / (x + y)
            later.append(y)
        before, after = np.array(parts), np.array(later[::-1])
        marginal = before * after / (before * after + (1 - before) * (1 - after))
        return float(-np.expm1(min(clean - whole, 0.0))), places, marginal

    def judge(self, text: str | None) -> tuple[float, list[dict]]:
        """Chance that any known word of a text is toxic, and the words that probably are: code point offsets and marginal."""
        data = (text or "").encode("utf-8", "replace")
        folded = data.translate(FOLD)
        bounds, numbers, start = [], [], 0
        while start < len(folded):
            stop = min(start + SEGMENT, len(folded))
            while stop < len(folded) and folded[stop] != 0x20:
                stop += 1
            words = folded[start:stop].split()
            if self.number.keys().isdisjoint(words):
                numbers.append(np.zeros(len(words), dtype=np.int32))
            else:
                numbers.append(np.fromiter(map(self.number.get, words, repeat(0)), np.int32, len(words)))
            bounds.append((start, stop))
            start = stop
        if not any(n.any() for n in numbers):
            return 0.0, []
        chance, places, marginal = self.known_words(np.concatenate(numbers))
        wanted = dict(zip(places[marginal >= 0.5].tolist(), marginal[marginal >= 0.5].tolist(), strict=True))
        spans, first, at, code_points = [], 0, 0, 0
        for (start, stop), ids in zip(bounds, numbers, strict=True):
            if not wanted.keys().isdisjoint(range(first, first + len(ids))):
                for k, word in enumerate(WORD.finditer(folded, start, stop), first):
                    if k in wanted:
                        code_points += len(data[at : word.start()].decode("utf-8", "replace"))
                        at = word.start()
                        end = code_points + len(word.group().decode("utf-8", "replace"))
                        spans.append({"start": code_points, "end": end, "marginal": wanted[k]})
            first += len(ids)
        return chance, spans


def _train(words: list[bytes], ids: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood with a small quadratic penalty, by gradient steps of adapted size."""
    model = Field(words, np.zeros(3 + len(words)), np.zeros((2, 2)))
    if not len(ids):
        model.emit[0] = -20.0
        return model
    labels = ((ids > 0) & toxic[:, None]).astype(float)
    known = np.zeros((ids.shape[0], ids.shape[1] + 2))
    known[:, 1:-1] = ids > 0
    scale = weight.sum()
    states = labels.astype(int)
    seen = np.zeros((2, 2))
    for i in range(2):
        for j in range(2):
            seen[i, j] = (weight * ((states[:, :-1] == i) & (states[:, 1:] == j) & (ids[:, 1:] >= 0)).sum(axis=1)).sum()

    def sums(values: np.ndarray) -> np.ndarray:
        weighted = values * weight[:, None]
        by_word = np.bincount(np.maximum(ids, 0).ravel(), weighted.ravel(), len(words) + 1)[1:]
        return np.concatenate(([weighted.sum(), (weighted * known[:, :-2]).sum(), (weighted * known[:, 2:]).sum()], by_word))

    target = sums(labels)
    mean, square = [np.zeros(3 + len(words)), np.zeros((2, 2))], [np.zeros(3 + len(words)), np.zeros((2, 2))]
    for step in range(1, STEPS + 1):
        marginal, pairs, _ = model.forward_backward(ids)
        slopes = [(target - sums(marginal)) - PENALTY * model.emit, (seen - (pairs * weight[:, None, None]).sum(axis=0)) - PENALTY * model.move]
        for k, (value, slope) in enumerate(zip((model.emit, model.move), slopes, strict=True)):
            slope = slope / scale
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            value += 0.2 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-12)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Field:
    """The field for about ``sample`` labelled documents (all if there are fewer), chosen by a hash of the id.

    Words whose documents are nearly always toxic and whose neighbours vary (so that copies of one
    text do not count again and again) are the toxic tokens of toxic documents, also where they
    usually stand beside one another; every other token is clean. The field is fitted
    to the distinct word sequences, pieces of at most ``PIECE`` words that together are the whole texts, with their counts. What the driver gets is bounded by the sample. Rows without a label
    and labels without a document do not count; an id with several labels is toxic if one of them is.
    Without any toxic document every score is (nearly) zero.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("_id")).agg(F.max(label).alias("_toxic"))
    part = min(1.0, sample / max(known.count(), 1))
    # About ``sample`` rows of two numbers: small enough to be sent to every task.
    known = F.broadcast(known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < round(part * (1 << 20))))
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("text"))
    rows = narrow.join(known, "_id").select("text", (F.col("_toxic") > 0).alias("toxic"))
    rows = keep(rows, "labelled")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set((t.as_py() or "").encode("utf-8", "replace").translate(FOLD).split())) for t in batch.column("text")]
            words = [[w.decode("utf-8", "replace") for w in ws] for ws in words]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(words, pa.list_(pa.string()))], ["toxic", "words"])

    sets = keep(rows.mapInArrow(distinct, "toxic boolean, words array<string>"), "words")
    counted = sets.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if("toxic").alias("toxic"), F.count("*").alias("all")
    )
    likely = counted.filter((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PRECISION * F.col("all")))
    likely = {r["word"].encode("utf-8", "replace") for r in likely.select("word").collect()}

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                tokens = [b"", *(value.as_py() or "").encode("utf-8", "replace").translate(FOLD).split(), b""]
                found = sorted({tuple(tokens[k - 1 : k + 2]) for k in range(1, len(tokens) - 1) if tokens[k] in likely})
                columns = [[t[k].decode("utf-8", "replace") for t in found] for k in (1, 0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic.as_py()] * len(found), pa.bool_()), *(pa.array(c, pa.string()) for c in columns)], ["toxic", "word", "before", "after"]
                )

    around = rows.mapInArrow(neighbours, "toxic boolean, word string, before string, after string")
    around = around.groupBy("word", "before", "after").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("only"))
    varied = around.groupBy("word").agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("only")).alias("clean"))
    enough = (F.col("toxic") >= SURROUNDINGS) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean")))
    words = sorted(r["word"].encode("utf-8", "replace") for r in varied.filter(enough).select("word").collect())
    number = {w: k + 1 for k, w in enumerate(words)}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, marks = [], []
            for value, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                tokens = (value.as_py() or "").encode("utf-8", "replace").translate(FOLD).split()
                ids = np.fromiter(map(number.get, tokens, repeat(0)), np.int32, len(tokens))
                ids = np.pad(ids, (0, -len(ids) % PIECE), constant_values=-1)
                made += [p.tobytes() for p in ids.reshape(-1, PIECE)]
                marks += [toxic.as_py()] * (len(made) - len(marks))
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.bool_()), pa.array(made, pa.binary())], ["toxic", "ids"])

    counts = rows.mapInArrow(pieces, "toxic boolean, ids binary").groupBy("toxic", "ids").count().collect()
    ids = np.array([np.frombuffer(r["ids"], dtype=np.int32) for r in counts], dtype=np.int64).reshape(-1, PIECE)
    toxic, weight = np.array([r["toxic"] for r in counts], dtype=bool), np.array([r["count"] for r in counts], dtype=float)
    order = np.lexsort((toxic, *ids.T)) if len(ids) else np.zeros(0, dtype=int)
    return _train(words, ids[order], toxic[order], weight[order])


RESULT = "struct<score: double, spans: array<struct<start: bigint, end: bigint, marginal: double>>>"


def score(docs: DataFrame, model: Field, text: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with ``toxicity``: the score of the whole text, and the offending words by offset in code points.

    The score is the chance that at least one known word is toxic, by the field over the whole text. A null
    or empty text, or one without known words, scores 0 without spans. Rows are judged one by one; a column of that name is replaced.
    """
    docs = docs.drop(name)
    columns = docs.columns
    schema = docs.withColumn(name, F.lit(None).cast(RESULT)).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [dict(zip(("score", "spans"), sent.value.judge(t.as_py()), strict=True)) for t in batch.column(text)]
            result = pa.array(made, pa.struct([("score", pa.float64()), ("spans", span)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), result], [*columns, name])

    return docs.mapInArrow(run, schema)
