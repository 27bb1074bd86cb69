"""From raw documents to shards of training data, one operator after another.

Each stage gets all that the one before it kept, as a Parquet table, and returns the columns of
``documents``; the last adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import decontaminate, language, mixing, sharding, simhash, toxicity
from closebook.llm.common import free_name, keep, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the field is fitted to the labels of two thirds of them."""
    labels = table(spark, sf_dir, "labels").filter(language.fold("doc_id", 3) != 1)
    name = free_name(docs.columns, "toxicity")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), name=name)
    return scored.filter(F.col(f"{name}.score") < toxicity.REJECT).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose fingerprints are linked."""
    return simhash.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that mostly consist of them go. ``n_chars`` follows the text."""
    name = free_name(docs.columns, "contamination")
    found = decontaminate.remove(decontaminate.find(docs, table(spark, sf_dir, "benchmark"), name=name), name=name)
    if "n_chars" not in docs.columns:
        return found
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return found.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard."""
    return sharding.assign(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]
#: Fingerprints and the random field cannot be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
