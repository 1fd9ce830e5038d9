"""From raw documents to packed training sequences, in four stages.

Each stage takes all that its predecessor kept. The first three return documents, with
the columns of the table documents; the last returns where each piece of tokens goes.
A document that the mix takes twice is two rows.

Defined results are those of the operators: a null or empty text fails the quality
rules; near copies of similarity 0.80 or more on five-word shingles are one group, of
which the least id stays, once if its row is repeated; a null language or source is one
of its own; very long texts are read whole; ties go by a text's hash; an empty table
gives no rows; columns beside doc_id, text, lang, source and n_chars pass through all
stages but the last under their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm import minhash, mixing, packing, quality, queries
from plinth.llm.store import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.keep_one(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mixing.mix(docs).filter("copies > 0")
    return taken.withColumn("__p_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return queries.packed(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]

#: SQL has no words for MinHash or best fit; tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the last one wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
