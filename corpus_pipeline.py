"""From raw documents to token ids: five stages, each one operator of visitry.llm over all that the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of docs, whatever these are; whole
rows pass through, and n_chars is kept right where a text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitry.llm.bpe import bpe_encode
from visitry.llm.catalog import vocabulary_path
from visitry.llm.classifier import keep_quality
from visitry.llm.decontaminate import drop_contaminated
from visitry.llm.near_copies import drop_near_copies
from visitry.llm.pii import redact
from visitry.llm.text import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of those in docs, does not reject."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Near copies have at least 0.8 of their five-word shingles in common, or are linked by such pairs. Null, empty and
    blank texts are copies of each other; rows without a doc_id stay.
    """
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every text."""
    return bpe_encode(docs, vocabulary_path()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: No SQL can express a fitted classifier or BPE; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again, as one job after another."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
