"""From raw documents to a training mix, one stage per operator of ``trendloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import decontaminate, mixing, near_copies, suffix_dedup, toxicity
from trendloom.llm.common import source, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.without_toxic(docs, source(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by the shingles they share, one document stays."""
    return near_copies.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words, or of 400 bytes, that occur more than once are cut out of the texts."""
    return suffix_dedup.without_repeats(docs, words=suffix_dedup.PASSAGE_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(spark, docs, source(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of their copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
]

# Fingerprints, suffix sorts and classifiers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
