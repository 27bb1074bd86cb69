"""License scans over a positional index of licence words (operator 5)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import WORD_CLASS, WORD_PATTERN, free_prefix, keep


@dataclass(frozen=True)
class Template:
    """A licence text. ``keys`` are phrases that must occur; without them the text itself must, word for word."""

    label: str
    text: str
    keys: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return re.findall(WORD_CLASS, self.text.lower())


# The phrases that alone decide a label.
PHRASES = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)
# Sentences by which public licences are known, and the phrases without which they are not meant.
NOTICES = (
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc", "4 0")),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        ("hereby granted free of charge", "without restriction"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("source and binary forms", "conditions are met"),
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)
RARE = 6  # words of a notice that are looked up, those with the highest IDF
SHARE = 0.8  # of them that must stand at the same relative position


def vocabulary(templates: Sequence[Template]) -> list[str]:
    words = {w for t in templates for w in t.words} | {w for t in templates for k in t.keys for w in k.split()}
    return sorted(words)


def folded(text: str) -> Column:
    """Text with A-Z in lower case; no other character becomes an ASCII one by itself (the Kelvin sign would)."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))


def _split(docs: DataFrame, text: str, words: list[str], name: str) -> DataFrame:
    """``docs`` without the text, with all its words in order (``name``) and the licence words among them (``present``)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "present")]
    # One projection after another, so that each result is computed once.
    split = docs.select(*others, F.regexp_extract_all(folded(text), F.lit(WORD_PATTERN), F.lit(0)).alias(name))
    return split.withColumn("present", F.array_intersect(name, F.array(*[F.lit(w) for w in words])))


def frequencies(docs: DataFrame, text: str, words: list[str]) -> dict[str, int]:
    """In how many documents each licence word occurs; as many rows as there are licence words."""
    found = _split(docs.select(text), text, words, "found")
    counted = dict(tuple(r) for r in found.select(F.explode("present").alias("word")).groupBy("word").count().collect())
    return {w: counted.get(w, 0) for w in words}


def index(docs: DataFrame, text: str, words: list[str], needed: Sequence[Sequence[str]]) -> DataFrame:
    """``docs`` without the text, with ``n_words`` and ``body``.

    A phrase can only be there if all its words are, and a notice has a share above 0 only if its two rarest words
    are; ``needed`` lists these words, and ``body``, all words in order, is kept where one of the lists is there as a whole.
    """
    found = free_prefix(docs.columns) + "found"
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "present")]
    possible = reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [F.array_contains("present", w) for w in sorted(set(ws))]) for ws in needed],
    )
    size = F.size(found).cast("long").alias("n_words")
    return _split(docs, text, words, found).select(*others, size, F.when(possible, F.col(found)).alias("body"))


def _starts(columns: dict[str, Column], words: Sequence[str], chosen: Sequence[int]) -> list[Column]:
    """For some words of a text, where the text starts if they are part of it."""
    return [F.transform(columns[words[k]], lambda place: place - F.lit(k)) for k in chosen]


def _all_of(starts: list[Column]) -> Column:
    """Starts on which all words agree; the rarest word comes first, and where it is absent nothing else is looked at."""
    none = F.array().cast("array<int>")
    return F.when(F.size(starts[0]) == 0, none).otherwise(reduce(F.array_intersect, starts))


def scan(docs: DataFrame, text: str = "text", phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``spans``, ``base_labels``, ``labels`` and ``license_score``.

    ``spans`` has (start, length, label) in words of every place where a phrase's words stand
    consecutively. ``labels`` also has the notices of whose ``RARE`` highest-IDF words a share of
    at least ``SHARE`` stands at one relative position (the two rarest among them) and whose key phrases all occur;
    ``license_score`` is the largest such share, 1 for a phrase. IDF follows from all rows.

    A null or empty text has no words, no label and the score 0; repeated rows get equal results; an empty table
    gives an empty result. Columns of ``docs`` with the names of results are replaced. Templates are few
    and fixed, so their words are part of the query and not joined.
    """
    results = ["n_words", "present", "body", "spans", "base_labels", "labels", "license_score"]
    docs = docs.drop(*[c for c in results if c != text])
    own = free_prefix(docs.columns)  # of intermediate columns
    postings = f"{own}postings"
    templates = [*phrases, *notices]
    words = vocabulary(templates)
    df = frequencies(docs, text, words)

    def rarest(listed: Sequence[str]) -> list[int]:
        return sorted(range(len(listed)), key=lambda k: (df[listed[k]], k))

    needed = [t.words for t in phrases] + [[t.words[k] for k in rarest(t.words)[:2]] for t in notices]
    indexed = keep(index(docs, text, words, needed), "licence-index")
    posted = F.filter(F.transform("body", lambda w, k: F.struct(w.alias("word"), k.alias("place"))), lambda p: p["word"].isin(words))
    indexed = indexed.withColumn(postings, F.coalesce(posted, F.array().cast("array<struct<word: string, place: int>>")))
    by_word = [
        F.transform(F.filter(postings, lambda p: p["word"] == w), lambda p: p["place"]).alias(f"{own}{k}") for k, w in enumerate(words)
    ]
    others = [F.col(f"`{c}`") for c in indexed.columns if c != "body"]
    places = indexed.select(*others, *by_word)
    columns = {w: F.col(f"{own}{k}") for k, w in enumerate(words)}

    def consecutive(listed: Sequence[str]) -> Column:
        return _all_of(_starts(columns, listed, rarest(listed)))

    spans = F.flatten(
        F.array(*[
            F.transform(
                consecutive(t.words),
                lambda s: F.struct(s.alias("start"), F.lit(len(t.words)).alias("length"), F.lit(t.label).alias("label")),
            )
            for t in phrases
        ])
    )

    def share(t: Template) -> Column:
        chosen = rarest(t.words)[:RARE]
        starts = _starts(columns, t.words, chosen)
        both = _all_of(starts[:2])
        agree = sum(F.when(F.size(F.array_intersect(both, s)) > 0, 1).otherwise(0) for s in starts[2:]) if len(starts) > 2 else F.lit(0)
        return F.when(F.size(both) > 0, (agree + len(starts[:2])) / F.lit(float(len(starts)))).otherwise(F.lit(0.0))

    scored = places.select(*others, *[f"{own}{k}" for k in range(len(words))], spans.alias("spans"), *[share(t).alias(f"{own}share{k}") for k, t in enumerate(notices)])
    named = []
    for k, t in enumerate(notices):
        keys = reduce(lambda a, b: a & b, [F.size(consecutive(key.split())) > 0 for key in t.keys])
        named.append(F.when((F.col(f"{own}share{k}") >= SHARE) & keys, F.lit(t.label)))
    base = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(base, F.array_compact(F.array(*named)))))
    score = F.greatest(F.when(F.size("spans") > 0, 1.0).otherwise(0.0), *[F.col(f"{own}share{k}") for k in range(len(notices))])
    kept = [F.col(f"`{c}`") for c in indexed.columns if c not in ("body", postings)]
    return scored.select(*kept, "spans", base.alias("base_labels"), labels.alias("labels"), score.alias("license_score"))
