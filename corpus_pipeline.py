"""The corpus pipeline: documents without toxic texts, near copies, benchmark passages and personal data, mixed to weights.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before
it kept, and returns the columns of ``docs``; the last one adds its sampling rate
and number of copies. ``run`` writes each result as Parquet to the shared folder
and reads it again, so a lost executor never repeats an earlier stage. Empty
tables, null texts and further columns pass as the operators describe.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from creditlake.llm.common import table
from creditlake.llm.decontamination import remove_contaminated
from creditlake.llm.jaccard import one_of_each_group
from creditlake.llm.mixing import sampled_documents
from creditlake.llm.pii import redact
from creditlake.llm.toxicity import Settings, fit, remove_toxic
from creditlake.operators.skew import shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the Kneser-Ney models call toxic; learned from the labelled rows of ``docs``."""
    return remove_toxic(docs, fit(docs, table(spark, sf_dir, "labels"), Settings(pairs=True)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group that five-word shingles link at 0.8."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of ten words of a benchmark item."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text by its kind."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents by rates raked to source, language and topic."""
    return sampled_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("n-gram jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("mixing to target weights", mixture),
]

# Learned models and iterative signatures have no SQL; tests/llm holds the
# pipeline against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
