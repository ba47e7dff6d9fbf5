"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` are applied in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

1. quality: documents whose quality score is below the threshold go.
2. near_duplicates: one document of each component stays (the smallest id).
   Different texts under one id are documents of their own, equal ones are one.
3. decontaminate: documents that hold a benchmark item go.
4. redact: personal data is replaced by its kind; ``n_chars`` follows.
5. pack: the texts' token ids in sequences; one row per piece.

Nulls: a document with a null text is judged like an empty one; a document
without id is never a duplicate. Other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from immolens.llm.decontaminate import decontaminated
from immolens.llm.neardup import one_of_each_group
from immolens.llm.packing import pack, packed_digest
from immolens.llm.pii import redacted_documents
from immolens.llm.quality import accepted_documents
from immolens.llm.tables import ship_package, stored, table

ORACLE_SQL = None        # trained models and token ids: tested against brute force instead


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return accepted_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return redacted_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packed_digest(pack(docs))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicate_groups),
    ("decontamination", benchmark_decontamination),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not packing:
            docs = stored(docs, name)
    return docs
