"""A training-data pipeline: five stages over ``documents``, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's documents. All but the
last return the columns of ``documents``.

Rows that are null in any column, empty, repeated or very long are handled as
the operators' docstrings say; extra columns go along to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import quality_pu
from freshet.llm.common import table
from freshet.llm.decontaminate import remove_contaminated
from freshet.llm.pii_anchors import mask_pii
from freshet.llm.queries import GOOD, N_BEST, TOKENIZER
from freshet.llm.sentencepiece_nbest import encode
from freshet.llm.simhash import one_of_each
from freshet.llm.simhash_similar import similar_documents
from freshet.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    model = quality_pu.fit(docs, table(spark, sf_dir, "labels"))
    return quality_pu.keep_good(docs, model, GOOD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints are close or whose five-word shingles are 0.8 alike."""
    return one_of_each(docs, similar_documents(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of the benchmark; drop documents that consist mainly of them."""
    return _measured(remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data."""
    return _measured(mask_pii(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts: the best segmentation, and the next ones as edits of it."""
    return encode(docs, TOKENIZER, n=N_BEST)


def _measured(docs: DataFrame) -> DataFrame:
    """With n_chars of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]

# SQL can't express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; what the stages hand on lies under ``spark.checkpoint.dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
