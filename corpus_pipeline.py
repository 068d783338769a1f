"""From raw documents to encoded ones: five stages, each written as Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontamination, near_duplicates, substring_dedup, toxicity
from tidemark.llm.common import table
from tidemark.sources.files import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of least id."""
    return near_duplicates.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents stay in the first one only; texts are cut, no document goes."""
    return substring_dedup.remove_passages(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    return bpe.encode_decode_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The stages learn and cluster; SQL cannot express them, so the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to encodings."""
    docs = table(spark, sf_dir, "documents")
    where = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{where}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{where}/{name}")
    return docs
