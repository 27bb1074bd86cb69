"""The quality model against brute force, held-out labels and odd input."""

from __future__ import annotations

import math
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from closebook.llm import quality

DOCS = "doc_id long, text string, quality string, `a.b` map<string,int>, features int, target int"
ODD = [None, "", " \n ", "one", "Word " * 200_000, "naïve Straße 東京\nx\nx", "## $$ %% 12", "😀 ok"]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "q", {"x": k}, k, k) for k, t in enumerate(texts)], DOCS)


def plain_features(text):
    """The features of a text, character by character."""
    data = (text or "").encode()
    words = [w for w in data.replace(b"\t", b" ").split()]
    is_letter = lambda b: b >= 128 or chr(b).isalpha()
    letters = [b for b in data if is_letter(b)]
    ink, n = max(len([b for b in data if b not in b" \t\n\r\x0b\x0c"]), 1), max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    follow = [(words[k], words[k + 1]) for k in range(len(words) - 1)]
    share = lambda chars: len([b for b in data if b in chars])
    symbols = [b for b in data if 32 < b < 127 and not is_letter(b) and chr(b) not in "0123456789.,;:!?'\"()-"]
    return [
        math.log(len(words) + 1), len(letters) / ink, len([b for b in letters if b < 128 and chr(b).isupper()]) / max(len(letters), 1),
        share(b"0123456789") / ink, share(b".,;:!?'\"()-") / ink, len(symbols) / ink, share(b" \t\n\r\x0b\x0c") / max(len(data), 1),
        share(b"\n") / n, sum(map(len, words)) / n, len(set(words)) / n, max((words.count(w) for w in set(words)), default=0) / n,
        len([w for w in words if len(w) <= 3]) / n, 1 - len(set(lines)) / max(len(lines), 1),
        len(set(follow)) / max(len(follow), 1), share(b".!?") / n, len([1 for a, b in follow if a == b]) / max(len(follow), 1),
    ]


def test_features_one_by_one():
    for text in [*ODD[:4], *ODD[5:7], "A b. A b! C\n\nd, e-f (3) |x| A b.\nd, e-f (3) |x| A b.\n", "the the the cat\r\nsat\x0bdown"]:
        assert quality.features(text) == pytest.approx(plain_features(text)), text


def best_of(slope, curve, weight, leaves):
    """The largest gain over all ways to cut a row of bins into up to so many leaves."""
    gain = lambda a, b: sum(slope[a:b]) ** 2 / (sum(curve[a:b]) + quality.RIDGE) if sum(weight[a:b]) >= quality.LEAST else -math.inf
    cuts = [(0, *c, len(slope)) for n in range(leaves) for c in product(range(1, len(slope)), repeat=n) if list(c) == sorted(set(c))]
    return max(sum(gain(a, b) for a, b in zip(c[:-1], c[1:], strict=True)) for c in cuts)


def test_trees_are_the_best_ones():
    random = np.random.default_rng(3)
    for _ in range(20):
        slope, curve, weight = random.normal(size=9), random.random(9) + 0.1, random.integers(1, 9, 9).astype(float)
        made = quality.tree(slope, curve, weight)
        assert len(np.unique(made)) <= 3
        reached = sum((slope[made == v].sum()) ** 2 / (curve[made == v].sum() + quality.RIDGE) for v in np.unique(made))
        assert reached == pytest.approx(best_of(slope, curve, weight, 3))
        for v in np.unique(made):
            assert v == pytest.approx(slope[made == v].sum() / (curve[made == v].sum() + quality.RIDGE))


def test_cross_trees_are_the_best_ones():
    random = np.random.default_rng(4)
    slope, curve, weight = random.normal(size=(4, 5)), random.random((4, 5)) + 0.1, np.full((4, 5), 9.0)
    made, gain = quality.cross_tree(slope, curve, weight)

    def total(i, j):
        parts = [(slice(i), slice(j)), (slice(i), slice(j, 5)), (slice(i, 4), slice(j)), (slice(i, 4), slice(j, 5))]
        return sum(slope[p].sum() ** 2 / (curve[p].sum() + quality.RIDGE) for p in parts)

    best = max(total(i, j) for i in range(5) for j in range(6))
    assert gain == pytest.approx(best - total(0, 0)) and len(np.unique(made)) <= 4


def test_bins_hold_equal_weight_and_split_no_value():
    values, weight = np.array([1.0, 1.0, 2.0, 3.0, 5.0]), np.array([90.0, 5.0, 2.0, 2.0, 1.0])
    assert quality._cuts(values, weight).tolist() == [1.5, 2.5, 4.0]
    assert quality._cuts(np.ones(4), np.ones(4)).tolist() == []
    many = np.random.default_rng(0).normal(size=10_000)
    inside = np.histogram(many, [-np.inf, *quality._cuts(many, np.ones(10_000)), np.inf])[0]
    assert len(inside) == quality.BINS and inside.max() < 200


def test_an_interaction_is_learnt():
    """Neither of two features tells anything alone; their pair tells all."""
    random = np.random.default_rng(5)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, 3:5] = random.random((4000, 2))
    y = ((x[:, 3] > 0.5) ^ (x[:, 4] > 0.5)).astype(float)
    model = quality.train(x[:3000], y[:3000], np.ones(3000))
    assert (3, 4) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
    assert all(abs(t[b].mean()) < 1e-9 for t, b in zip(model.tables, model.bins(x[:3000]), strict=True))


def test_scores_are_sums_of_table_entries(spark):
    texts = [f"good words {'that differ ' * (k % 7)} all the time {k}." for k in range(60)]
    texts += [f"{'bad ' * (k + 5)}bad" for k in range(40)] + [f"### $$$ {'%% ' * k}" for k in range(20)] + ODD
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(len(texts))], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert rows[0].asDict().keys() >= {"quality", "quality_", "a.b", "features", "target"} and len(rows) == docs.count()
    for r in rows:
        log_odds, values = model.intercept, quality.features(r.text)
        place = [sum(v >= c for c in cuts) for v, cuts in zip(values, model.cuts, strict=True)]
        log_odds += sum(t[k] for t, k in zip(model.tables, place, strict=True))
        log_odds += sum(t[model.coarse[i][place[i]], model.coarse[j][place[j]]] for (i, j), t in model.pairs.items())
        assert r.quality_.score == pytest.approx(1 / (1 + math.exp(-log_odds)))
        assert len(r.quality_.parts) == len(model.names())
        assert model.intercept + sum(r.quality_.parts) == pytest.approx(log_odds)
    good = [r.quality_.score for r in rows if r.doc_id < 60]
    assert min(good) > max(r.quality_.score for r in rows if 60 <= r.doc_id < 120)


def test_odd_labels_and_tables(spark):
    docs = frame(spark, ODD)
    none = labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.quality_.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(None, 1), (0, None), (99, 1), *[(k, 1) for k in range(8)]], "doc_id long, quality int")
    assert min(r.quality_.score for r in quality.score(docs, quality.fit(docs, labels)).collect()) > 0.9
    model = quality.fit(docs.limit(0), labels)
    assert quality.score(docs.limit(0), model).count() == 0 and model.score(quality.matrix(pa.array(["x"]))).tolist() == [0.5]


def test_what_the_driver_gets_is_bounded(spark, monkeypatch):
    """One labelled id with a thousand texts, and copies that count as one row with a weight."""
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y, weight: seen.append((len(x), weight.sum())))
    docs = frame(spark, ["a b c"] * 500).unionByName(frame(spark, ["w " * k for k in range(1000)]).withColumn("doc_id", F.lit(7).cast("long")))
    labels = spark.createDataFrame([(k, 1) for k in range(500)], "doc_id long, quality int")
    quality.fit(docs, labels)
    assert seen[0][0] <= 1001 and seen[0][1] == 1500  # all rows, copies as one
    quality.fit(docs, labels.filter("doc_id = 7"), sample=50)
    assert seen[1][0] < 200


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    model = quality.fit(docs, labels.filter(~F.col("doc_id").isin(*held)))
    found = {r.doc_id: r.quality.score for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    right = [(found[k] >= quality.ACCEPT) == bool(v) for k, v in held.items()]
    assert len(right) > 100 and sum(right) / len(right) > 0.97
