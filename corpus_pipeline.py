"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the docs of the next one. All but the last keep the columns of documents.

Defined cases: rows without text or words are judged, deduplicated and passed on like others (as texts without words are equal, one
of them stays); rows without an id never go as copies of a near copy; rows that repeat an id or a text are told apart by row; very long
texts are read whole; ties go as each operator has it; an empty table gives an empty result; extra columns are kept up to packing, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velatura.llm import exact_dedup, mixing, packing, quality, simhash
from velatura.llm.common import shared_folder, table
from velatura.llm.queries import site, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is under one half go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"), *site(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id stays."""
    return simhash.simhash_dedup(docs, shingle=5, least=0.8)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens."""
    # executors still hold what earlier stages took, so workers keep a smaller table of words here, and none between tasks
    return packing.pack(docs, tokenizer_path(), table=60_000, keep_table=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("mixing to target weights", mix_stage),
    ("packing", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what lies between is written to the shared checkpoint folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


#: The quality classifier and the tokenizer have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
