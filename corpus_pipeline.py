"""Cleaning pipeline over ``documents``: toxic documents go, repeated lines go,
one document of each near-duplicate group stays, documents with benchmark
passages go, and what is left is encoded.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.

Defined cases (beside those of the operators): rows whose ids repeat or are
null are judged row by row; of a near-duplicate group one row stays, that with
the smallest id (null last) and, of rows with one id, the smallest hash of its
columns; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epispark.llm import op1_sentencepiece, op3_simhash, op4_toxicity, op7_line_dedup, op10_decontamination
from epispark.llm.common import saved


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return op4_toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds."""
    out = op7_line_dedup.drop_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return op3_simhash.first_rows(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return op10_decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled SentencePiece ids of every document that is left."""
    return op1_sentencepiece.encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Trained dictionaries, 64-bit fingerprints and sampled segmentations are no SQL:
#: tests/llm compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
