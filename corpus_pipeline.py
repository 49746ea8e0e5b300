"""The corpus pipeline: documents in, sampled segmentations of what is kept out.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; :func:`run` writes each stage's result as Parquet to the
shared folder and reads it again as the next stage's documents.

Null ids and texts, empty and very long texts, repeated rows, ties, tables
without rows and columns of any further name are no error in any stage; what
they give stands with the operator that the stage calls.  All stages but the
last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, lattice_sampling, line_dedup, simhash, toxicity
from tillroll.llm.common import staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, trained on ``labels`` and these texts, rejects; null and empty texts stay unless all labels are toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that match an earlier line of the corpus; n_chars follows the text, null with it.  No row goes."""
    out = line_dedup.deduplicate(docs, counts=False)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: the one with the smallest id; all empty and null texts are one component."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark window; texts without words stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sample_segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every text, as piece ids; a text without words has one row without pieces."""
    return lattice_sampling.encode(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", remove_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece_sampling", sample_segmentations),
]

#: A trained classifier and a sampler are stages that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
