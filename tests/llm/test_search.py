"""Ranked search against a plain index, and on odd input."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from closebook.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, item int, term string, score string, rank map<string,int>"


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain(docs, items, top=50):
    """The same ranking with an index of every document."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    number, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in wanted.items():
        scores = []
        for i, c in counts:
            middle = 50 + 50 * sum(c.values()) * number // length
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * middle)) for t in words if t in c)
            scores += [(i, score)] if score > 0 else []
        scores.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        rows += [(item, k, i, s) for k, (i, s) in enumerate(scores[:top], 1)]
    return sorted(rows, key=str)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", {"z": 1}) for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, term string, doc int")


def found(spark, docs, items, **options):
    return sorted(map(tuple, search.rank(docs_of(spark, docs).repartition(5), items_of(spark, items), **options).collect()), key=str)


CORPUS = [
    (k, " ".join(["alpha", "beta", "gamma-ray", "Delta", "naïve", "東京", "x1"][(k * j + j) % 7] for j in range(k % 9 + 1))) for k in range(120)
]
CORPUS += [(200, None), (201, ""), (202, " .,- \n"), (203, "Kelvin İstanbul ß"), (3, "alpha repeats an id"), (None, "beta without an id"), (204, "gamma " * 300_000)]
ITEMS = [(0, "Alpha BETA"), (1, "gamma ray delta"), (2, "東京 naïve NAÏVE"), (3, None), (4, ""), (5, "!!"), (6, "nowhere"), (1, "x1"), (None, "kelvin"), (7, "istanbul i̇stanbul İstanbul")]


def test_ranks_by_brute_force(spark):
    assert found(spark, CORPUS, ITEMS) == plain(CORPUS, ITEMS)
    assert found(spark, CORPUS, ITEMS, top=3) == plain(CORPUS, ITEMS, 3)


def test_blocks_segments_and_pruning(spark, monkeypatch):
    """Many blocks of items, tiny pieces of text and few documents at once change nothing."""
    wanted = plain(CORPUS, ITEMS, 4)
    for name, value in (("BLOCK_BYTES", 40), ("SEGMENT", 3), ("CELLS", 20)):
        monkeypatch.setattr(search, name, value)
        assert found(spark, CORPUS, ITEMS, top=4) == wanted, name


def test_equal_scores_follow_the_id(spark):
    docs = [(k, "same words here") for k in range(300, 0, -1)] + [(k, "other text") for k in range(400, 1000)]
    rows = found(spark, docs, [(9, "words")])
    assert sorted((r[1], r[2]) for r in rows) == [(k, k) for k in range(1, 51)]


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "key string, body string")
    items = spark.createDataFrame([("q", "y"), (None, "z")], "name string, words string")
    rows = search.rank(docs, items, "key", "body", "name", "words").collect()
    assert sorted(((r.item_id, r.rank, r.doc_id) for r in rows), key=str) == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None), (None, 1, "c")]


def test_empty_tables(spark):
    for docs, items in (([], ITEMS), (CORPUS[:3], []), ([(1, None)], ITEMS), (CORPUS[:3], [(1, None)])):
        result = search.rank(docs_of(spark, docs), items_of(spark, items))
        assert result.columns == ["item_id", "rank", "doc_id", "score"] and result.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from([*"ab AB1-_\n.\x00 é", "İ"]), max_size=60))
def test_counts_of_a_text(text):
    scanner = search.Scanner(["a", "b", "ab", "a1", "é", "aé", "a b"])
    total, counted = scanner.count(text)
    wanted = Counter(terms(text))
    assert total == sum(wanted.values())
    assert {scanner.terms[k]: n for k, n in counted.items()} == {t: n for t, n in wanted.items() if t in scanner.terms}


def test_scores_beyond_64_bits_in_between():
    """A very long document in a very large corpus: the length term needs more than 64 bits on the way."""
    import numpy as np

    ranking = search.Ranking(np.array([5000]), np.array([0, 1]), np.array([0]), 1, 10**12, 10**15)
    n, tf = 10**9, 10**9
    middle = 50 + 50 * n * 10**12 // 10**15
    score = ranking.scores(np.array([n]), np.array([0, 1]), np.array([0]), np.array([tf]))
    assert score.tolist() == [[5000 * (10**9 * tf // (1000 * tf + 20 * middle))]]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_weights_are_never_negative(n):
    assert all(search._weight(n, df) >= 0 for df in range(n + 1))
