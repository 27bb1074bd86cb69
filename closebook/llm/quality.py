"""Text quality by a generalised additive model with pairwise interactions (operator 11)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import keep

SAMPLE = 20_000  # labelled documents, about, that the model is fitted to
BINS = 64  # of a feature, at quantiles of the sample
COARSE = 16  # bins of a feature within a pair
PAIRS = 8  # interactions
ROUNDS, PAIR_ROUNDS = 300, 100  # through all features, and then through all pairs
PATIENCE = 30  # rounds without a gain on the rows kept back
RATE = 0.1
HELD = 5  # one in so many rows is kept back to choose the number of rounds
LEAST = 4.0  # rows, by weight, in a leaf
RIDGE = 1.0  # added to a leaf's curvature
ACCEPT = 0.5

_BYTES = np.arange(256)
_LETTER = np.isin(_BYTES | 32, np.arange(97, 123)) & (_BYTES < 128) | (_BYTES >= 128)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_BLANK = (_BYTES == 32) | (_BYTES >= 9) & (_BYTES <= 13)
_END = np.isin(_BYTES, list(b".!?"))
_MARK = np.isin(_BYTES, list(b".,;:!?'\"()-"))
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT & ~_MARK

#: What :func:`features` returns, in order.
FEATURES = (
    "log_words", "letters", "capitals", "digits", "marks", "symbols", "blanks", "lines_per_word", "word_bytes", "distinct_words",
    "commonest_word", "short_words", "repeated_lines", "distinct_pairs", "ends_per_word", "repeated_words",
)


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text, in any language; all but the first are shares or means, 0 if there is nothing to share."""
    data = (text or "").encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    often, lengths = Counter(words), np.fromiter(map(len, words), np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    letters, ink, n = int(seen[_LETTER].sum()), max(len(data) - int(seen[_BLANK].sum()), 1), max(len(words), 1)
    follow = list(zip(words, words[1:], strict=False))
    return [
        float(np.log1p(len(words))),
        letters / ink,
        int(seen[_UPPER].sum()) / max(letters, 1),
        int(seen[_DIGIT].sum()) / ink,
        int(seen[_MARK].sum()) / ink,
        int(seen[_SYMBOL].sum()) / ink,
        int(seen[_BLANK].sum()) / max(len(data), 1),
        int(seen[10]) / n,
        int(lengths.sum()) / n,
        len(often) / n,
        max(often.values(), default=0) / n,
        int((lengths <= 3).sum()) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        len(set(follow)) / max(len(follow), 1),
        int(seen[_END].sum()) / n,
        sum(a == b for a, b in follow) / max(len(follow), 1),
    ]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array([features(t.as_py()) for t in column], dtype=float).reshape(-1, len(FEATURES))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Additive:
    """log(p / (1 - p)) = intercept + one table per feature, by its bin, + one table per pair, by the coarse bins of both.

    ``cuts`` holds each feature's inner bin borders (a value on a border belongs to the upper bin),
    ``coarse`` the coarse bin of every bin.
    """

    cuts: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float = 0.0
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin of every value; one row per feature."""
        return np.array([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], dtype=np.int64).reshape(len(self.cuts), len(x))

    def parts(self, x: np.ndarray) -> np.ndarray:
        """What every feature and then every pair adds; one row per document."""
        bins = self.bins(x)
        found = [t[bins[k]] for k, t in enumerate(self.tables)]
        found += [t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]] for (i, j), t in self.pairs.items()]
        return np.array(found).reshape(len(found), len(x)).T

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.intercept + self.parts(x).sum(axis=1))

    def names(self) -> list[str]:
        return [*FEATURES, *(f"{FEATURES[i]} x {FEATURES[j]}" for i, j in self.pairs)]


def _cuts(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Borders between at most ``BINS`` bins of about equal weight, halfway between neighbouring values."""
    order = np.argsort(values, kind="stable")
    known, at = np.unique(values[order], return_index=True)
    if len(known) < 2:
        return np.zeros(0)
    below = np.cumsum(weight[order])[at[1:] - 1]  # weight of all values below each of known[1:]
    wanted = np.unique(np.minimum(np.searchsorted(below, weight.sum() * np.arange(1, BINS) / BINS), len(known) - 2))
    return (known[wanted] + known[wanted + 1]) / 2


def _leaf(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return slope / (curve + RIDGE)


def _gain(slope: np.ndarray, curve: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.where(weight >= LEAST, slope * slope / (curve + RIDGE), np.where(weight > 0, -np.inf, 0.0))


def tree(slope: np.ndarray, curve: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The best tree of up to three leaves over the bins of one feature: its value in every bin.

    Arguments are sums per bin of the loss's slope and curvature and of the weight.
    """
    s, c, w = (np.concatenate(([0.0], np.cumsum(v))) for v in (slope, curve, weight))
    n = len(slope)
    first, last = (v.ravel() for v in np.meshgrid(np.arange(n), np.arange(n), indexing="ij"))
    keep_ = first <= last  # 0 < first <= last: three leaves; first = last: two; both 0: one
    first, last = first[keep_], last[keep_]
    total = sum(_gain(v[b] - v[a], x[b] - x[a], y[b] - y[a]) for v, x, y, a, b in ((s, c, w, 0 * first, first), (s, c, w, first, last), (s, c, w, last, 0 * last + n)))
    best = int(np.argmax(total))
    out = np.zeros(n)
    for a, b in ((0, first[best]), (first[best], last[best]), (last[best], n)):
        if b > a:
            out[a:b] = _leaf(s[b] - s[a], c[b] - c[a])
    return out


def _quarters(table: np.ndarray) -> list[np.ndarray]:
    """Sums of the four quarters of a table for every place where it can be cut along both sides."""
    whole = np.pad(table.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    left, upper, corner = whole[:, -1:], whole[-1:, :], whole[-1, -1]
    return [whole, left - whole, upper - whole, corner - left - upper + whole]


def cross_tree(slope: np.ndarray, curve: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The best tree that cuts each of two features once: its values in every cell, and its gain over one leaf."""
    s, c, w = _quarters(slope), _quarters(curve), _quarters(weight)
    total = sum(_gain(*q) for q in zip(s, c, w, strict=True))
    i, j = np.unravel_index(int(np.argmax(total)), total.shape)
    out = np.zeros(slope.shape)
    for k, (rows, columns) in enumerate(((slice(i), slice(j)), (slice(i), slice(j, None)), (slice(i, None), slice(j)), (slice(i, None), slice(j, None)))):
        out[rows, columns] = _leaf(s[k][i, j], c[k][i, j])
    return out, float(total[i, j] - total[0, 0])


def _loss(y: np.ndarray, logit: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / max(weight.sum(), 1e-12))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Additive:
    """Cyclic boosting of shallow trees, one feature after another, round after round; then the same over the best pairs.

    ``y`` is the share of label 1 among the ``weight`` rows that each row stands for. The number of
    rounds is the one with the smallest loss on every ``HELD``-th row (in order of the rows given).
    Pairs are those whose best cross tree gains most on what the features leave unexplained.
    Without rows the score is 0.5 throughout, with one label only it is near that label.
    """
    count = len(FEATURES)
    cuts = [_cuts(x[:, k], weight) for k in range(count)]
    coarse = [np.arange(len(c) + 1) * COARSE // (len(c) + 1) if len(c) + 1 > COARSE else np.arange(len(c) + 1) for c in cuts]
    model = Additive(cuts, coarse, [np.zeros(len(c) + 1) for c in cuts])
    if not len(x):
        return model
    bins = model.bins(x)
    rough = np.array([c[b] for c, b in zip(coarse, bins, strict=True)])
    held = np.arange(len(x)) % HELD == HELD - 1
    learn = np.where(held, 0.0, weight)
    mean = float(np.clip((learn * y).sum() / learn.sum(), 1e-4, 1 - 1e-4))
    model.intercept = float(np.log(mean / (1 - mean)))
    logit = np.full(len(x), model.intercept)

    def sums(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = sigmoid(logit)
        return tuple(np.bincount(place, v, size) for v in (learn * (y - p), learn * p * (1 - p), learn))

    def boost(tables: list[np.ndarray], step, rounds: int) -> list[np.ndarray]:  # noqa: ANN001
        """The tables after the best round; ``step`` adds one tree to one table."""
        best, at, found = _loss(y[held], logit[held], weight[held]), 0, [t.copy() for t in tables]
        for turn in range(1, rounds + 1):
            for k in range(len(tables)):
                step(k)
            now = _loss(y[held], logit[held], weight[held])
            if now < best - 1e-6:
                best, at, found = now, turn, [t.copy() for t in tables]
            elif turn - at >= PATIENCE:
                break
        return found

    def add(k: int) -> None:
        made = RATE * tree(*sums(bins[k], len(model.tables[k])))
        model.tables[k] += made
        logit[:] += made[bins[k]]

    model.tables = boost(model.tables, add, ROUNDS)
    logit = model.intercept + sum(t[b] for t, b in zip(model.tables, bins, strict=True))

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (int(coarse[i][-1]) + 1, int(coarse[j][-1]) + 1)
        return rough[i] * shape[1] + rough[j], shape

    def grid(i: int, j: int) -> list[np.ndarray]:
        place, shape = cells(i, j)
        return [v.reshape(shape) for v in sums(place, shape[0] * shape[1])]

    gains = {(i, j): cross_tree(*grid(i, j))[1] for i, j in combinations(range(count), 2)}
    chosen = sorted(sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS])
    tables = [np.zeros(cells(i, j)[1]) for i, j in chosen]

    def add_pair(k: int) -> None:
        made = RATE * cross_tree(*grid(*chosen[k]))[0]
        tables[k] += made
        logit[:] += made.ravel()[cells(*chosen[k])[0]]

    model.pairs = dict(zip(chosen, boost(tables, add_pair, PAIR_ROUNDS), strict=True))
    # Every table gets a mean of 0 over the sample; the intercept takes what that removes.
    total = weight.sum()
    for k, t in enumerate(model.tables):
        shift = float((weight * t[bins[k]]).sum() / total)
        t -= shift
        model.intercept += shift
    for (i, j), t in model.pairs.items():
        shift = float((weight * t.ravel()[cells(i, j)[0]]).sum() / total)
        t -= shift
        model.intercept += shift
    return model


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Additive:
    """The model for about ``sample`` labelled documents (all if there are fewer), chosen by a hash of the id.

    Documents equal in all features and label count as one with a weight, and of more than twice
    ``sample`` different ones those go on whose hash is smallest, so that what the driver gets is bounded
    also if ids repeat. Rows with a null id or label, labels without a document and documents without a label do not count; an id
    with several labels has their mean. A null text is an empty one.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label).alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("id").agg(F.avg((F.col("label") > 0).cast("double")).alias("target"))
    part = min(1.0, sample / max(known.count(), 1))
    # About ``sample`` rows of two numbers: small enough to be sent to every task.
    known = F.broadcast(known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < round(part * (1 << 20))))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).join(known, "id").select("text", "target")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = pa.array(list(matrix(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("target"), listed], ["target", "features"])

    made = rows.mapInArrow(run, "target double, features array<double>")
    made = keep(made.groupBy("target", "features").agg(F.count("*").alias("weight")), "quality")
    part = min(1.0, 2 * sample / max(made.count(), 1))
    made = made.filter(F.pmod(F.xxhash64("features", "target"), F.lit(1 << 20)) < round(part * (1 << 20)))
    found = made.orderBy(F.xxhash64("features"), "features", "target").toArrow()  # the same order in every run
    x = np.array(found.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return train(x, found.column("target").to_numpy(), found.column("weight").to_numpy().astype(float))


def score(docs: DataFrame, model: Additive, text: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with one more column: ``score`` of the whole text, and ``parts``, what each feature and pair adds to its log odds.

    The column is called ``name``, with underscores appended while ``docs`` has a column of that
    name, so none is lost. ``parts`` follows ``model.names()``; with ``model.intercept`` it sums up
    to the log odds of label 1. Every text gets a score, null ones that of an empty text; rows are
    judged one by one.
    """
    while name in docs.columns:
        name += "_"
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, parts: array<double>>")
    def judge(texts: pa.Array) -> pa.Array:
        known = sent.value
        added = known.parts(matrix(texts))
        scores = sigmoid(known.intercept + added.sum(axis=1))
        listed = pa.array(list(added), pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array(scores), listed], ["score", "parts"])

    return docs.withColumn(name, judge(F.col(text).cast("string")))
