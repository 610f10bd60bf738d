"""Cleaning of a corpus: stages that each take the documents their predecessor kept.

Toxic documents go, then those of poor quality, then exact copies (the largest doc_id of equal texts
stays), then near copies (of each group the smallest doc_id stays); what is left is packed into
token sequences. All stages but the last return the columns of ``documents``. Each works on all
rows and whole texts that it gets; documents without a doc_id, too, are judged by their text.

Decisions meet their rows again by doc_id, or by place in the input where the operator gives it;
rows that share a doc_id are kept or dropped together in the first two stages, if any of them is
kept. An empty table goes through empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blockrisk.llm.best_fit_packing import pack_documents
from blockrisk.llm.byte_cnn import fit_quality, keep_good
from blockrisk.llm.jaccard_join import keep_first_of_groups
from blockrisk.llm.queries import END_ID, QUALITY_LEAST, TOXICITY_MOST, WORD_BPE
from blockrisk.llm.stream_dedup import keep_last_copies
from blockrisk.llm.string_kernel import fit_toxicity, keep_mild
from blockrisk.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_mild(docs, fit_toxicity(docs, _labels(spark, sf_dir)), TOXICITY_MOST)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, fit_quality(docs, _labels(spark, sf_dir)), QUALITY_LEAST)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_last_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one row stays: the one whose doc_id names the group, or any one where all lack a doc_id."""
    return keep_first_of_groups(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, WORD_BPE, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing),
]

#: The first two stages are fitted models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
