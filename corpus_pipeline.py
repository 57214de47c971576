"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all documents that the stage before it
kept; its decisions take effect on its result. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.decontaminate import contamination
from quarry.llm.mixing import mix_sources
from quarry.llm.neardup import Likeness, near_duplicates
from quarry.llm.quality import score_quality
from quarry.llm.store import table, written
from quarry.llm.substrings import cut_repeats

#: five words and a similarity of 0.8
NEAR = Likeness(words=5, percent=80)
QUALITY_THRESHOLD = 0.3
WINDOW = 20


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose doc_id, null included, is in ``keys``; repeated keys don't multiply rows."""
    keys = keys.select(F.col("doc_id").alias("_kept_id"))
    return docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, does not reject. Documents
    without a text are judged like others; without labels nothing is rejected."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"), threshold=QUALITY_THRESHOLD)
    return _only(docs, scored.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each near-duplicate component. Documents without
    words, and those with a null doc_id, are linked with nothing and stay."""
    found = near_duplicates(docs, NEAR)
    return _only(docs, found.where("component_id is null or component_id = doc_id"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows of 20 words that also start earlier; a document
    that consists of such words only goes. ``n_chars`` follows the text."""
    cut = cut_repeats(docs, window=WINDOW)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item. A null doc_id is never judged and stays."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in the tempered source mixture, globally shuffled; adds
    ``mix_rate``, ``mix_copy`` and ``mix_order``."""
    return mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: the first stage is a trained network, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
