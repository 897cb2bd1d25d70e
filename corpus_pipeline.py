"""Documents to training sequences, in five stages.

Each stage reads all that the one before kept; its own operator decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from synonymy.llm.common import cut, scratch
from synonymy.llm.decontaminate import uncontaminated
from synonymy.llm.minhash import deduplicated
from synonymy.llm.packing import pack
from synonymy.llm.pii import redacted
from synonymy.llm.toxicity import tolerated


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not predict toxic.

    Each row is judged by its whole text; a null or empty text has no hit and counts as
    one without hits.  Repeated rows are judged alike, rows without doc_id stay, and
    further columns are kept.  Without labels of both kinds all rows have one score,
    the share of label 1; without any labels nothing is rejected.
    """
    return tolerated(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group of near duplicates (five-word shingles, 0.8).

    Null, empty and blank texts are near nothing and stay; rows without doc_id stay.  Of
    rows that repeat a doc_id one stays, the least by its columns.
    """
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts match nothing and stay, as do all rows where the benchmark is
    empty; repeated rows are judged alike.
    """
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text.

    Null and empty texts stay as they are; spans that overlap are one.
    """
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, with their ids.

    A null or empty text is its end token alone; repeated rows are packed each.
    """
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packing)]

#: No SQL learns a lexicon or tokenises; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read back."""
    folder = scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, folder, f"{i}-{name}")
    return docs
