"""Documents made ready for training: judged, deduplicated, decontaminated and packed, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.llm import decontaminate, linededup, neardup, packing, quality
from eventrank.llm.common import read
from eventrank.sources.session import stored

# Near duplicates of the pipeline: shingles of five words, similar from 80 in 100.
SHINGLE = 5
PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1. Null, empty and blank texts are not accepted; repeated rows are judged alike."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; one that has lost all its visible lines is gone.

    Texts that never had a visible line, null ones too, stay. Repeated rows (equal id and text) have the same result.
    """
    rows = linededup.deduplicated(docs)
    rows = rows.where((F.size("removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id; of repeated rows one stays.

    Null and blank texts are like nothing and stay. A null id counts as larger than all others.
    """
    return neardup.deduplicated(docs, PERCENT, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items. Texts without words never are; repeated rows go together."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places. A null or empty text is one piece of its end token."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

# The first stage is a trained model, which SQL cannot state; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it. An empty table has no piece.

    The stored results lie below ``spark.checkpoint.dir`` until ``eventrank.sources.session.remove_scratch`` is called,
    which may be done as soon as the returned rows have been written.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
