"""A training corpus from raw documents, in five stages; each is written as Parquet and read again before the next.

Stages take (spark, docs, folder) and return a DataFrame. All but the last return the columns of ``documents``.

1. ``quality``: documents that the weak-label scorer rejects go.
2. ``exact``: of equal texts the row with the largest id stays.
3. ``similar``: of texts that five-word shingles link, directly or through others, the smallest id stays.
4. ``leaks``: documents that hold four fifths of a benchmark item's shingles go.
5. ``mixing``: every document gets the rate at which it is to be drawn, so that the expected tokens of the domains match
   their targets; documents of rate 0 go. Adds ``n_tokens``, the domains' posteriors and ``rate``.

A document is found again by its id and a hash of its text, so ids may repeat or be null. Other columns of ``documents``
pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality
from seriesprep.workspace import stage


# good, poor and toxic. Poor documents have gone by then: what is left of that domain is doubt about clean ones, and stays as it is. Clean
# documents are expected to hold one or two percent of toxic tokens; a lower target would cost clean documents
TARGETS = (None, None, 0.03)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    judged = quality.classify(docs).filter("keep").select(F.col("doc_id").alias("_judged"), "_key").distinct()
    return docs.join(judged, docs["doc_id"].eqNullSafe(judged["_judged"]) & (F.xxhash64(docs["text"]) == judged["_key"]), "left_semi")


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard_join.drop_similar(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, folder, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.with_rates(docs, _table(spark, folder, "labels"), TARGETS)


STAGES = [
    ("quality", drop_poor), ("exact", drop_copies), ("similar", drop_similar), ("leaks", drop_leaks), ("mixing", mix_domains),
]

ORACLE_SQL = None  # classifiers and clustering are not expressible; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
