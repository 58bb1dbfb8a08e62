"""The corpus pipeline: each stage works on all that the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of documents.
Nulls, empty texts, repeated rows, empty tables and extra columns are handled as their operators say: texts
without words fail the quality rules, so null and empty texts go there; rows that share a doc_id are one document,
and stay or go together; a null doc_id is compared with no other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import mcd, minhash_join, packing, suffix_dedup, templates
from waymark.llm.common import table, written

NEAR_WORDS, NEAR_PERCENT = 5, 80
REPEAT_BYTES = 200
END_ID = 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return mcd.keep_good(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    groups = minhash_join.near_groups(spark, docs, NEAR_WORDS, NEAR_PERCENT)
    gone = written(spark, groups.where("not kept").select(F.col("doc_id").alias("gone__")).distinct(), "near-gone")
    return docs.join(gone, docs.doc_id.cast("long") == gone["gone__"], "left_anti")


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur elsewhere; n_chars follows the text."""
    rest = suffix_dedup.remove_repeats(spark, docs, REPEAT_BYTES)
    made = {name: F.col(name) for name in docs.columns}
    if "n_chars" in made:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars")
    return rest.select(*made.values())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor one with other names and numbers."""
    return templates.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in full sequences."""
    return packing.pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate groups", near_dedup),
    ("suffix-array dedup", suffix_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("packing", sequence_packing),
]

#: The near-duplicate, suffix and packing stages have no SQL form; tests/llm/test_pipeline.py has a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again for the next."""
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if number < len(STAGES) - 1:
            rows = written(spark, rows, f"stage-{number}")
    return rows
