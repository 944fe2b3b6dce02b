"""The corpus pipeline: five stages, each on what the one before kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as
Parquet in the shared folder, rereads them as the next stage's input, and deletes
what a stage no longer needs.

Defined cases: null and letterless texts go in the first stage; null ids are
documents of their own; repeated rows count as copies; ties are broken as the
stages' operators say; very long texts are kept whole and cut only by packing; an
empty table gives an empty result; other columns ride along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import exact_dedup, language_id, simhash, source_mix
from tidewire.llm.common import discard, scratch, staged, table
from tidewire.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no learned language."""
    return language_id.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints."""
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return source_mix.apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences."""
    return pack(docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near), ("source mixing", mixture), ("best-fit packing", packing)]

#: Language prediction and tokens are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            keep.append(docs)
        if last is not None:
            discard(last)  # the stage's input
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
