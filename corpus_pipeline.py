"""Corpus pipeline: toxicity filter, line dedup, near-duplicate filter, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each result to the shared
folder as Parquet and rereads it as the next stage's documents. All but the last stage return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm.common import documents, stash


def _bare(docs: DataFrame) -> DataFrame:
    """doc_id, text and all columns in one (``__row``), so that no column's name meets one of an operator."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labelled training rows among ``docs``."""
    from caseload.llm.toxicity import toxicity as scored

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(_bare(docs), labels).where(F.col("predicted") == 0).select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, with its shorter text and its new length."""
    from caseload.llm.linededup import dedup_lines

    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("__row.`n_chars`"))}
    return dedup_lines(_bare(docs)).select(*[(new[c] if c in new else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at similarity 0.8, the one with the smallest id stays."""
    from caseload.llm.jaccard import keep_one

    return keep_one(docs, words=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or reworded, go."""
    from caseload.llm.decontam import decontaminate

    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens: one row per piece."""
    import public_tokenizers

    from caseload.llm.packing import pack

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Model fitting, graph search and packing have no SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
