"""Training-data pipeline over ``documents``: each stage is one of the corpus operators.

A stage takes ``(spark, docs, sf_dir)`` and returns documents with all their columns; the last
returns the packed pieces. Every stage works on all that the one before it kept, which is written
as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowgate.llm import decontaminate, lines, near_copies, packing, quality, simhash
from rowgate.llm.common import table
from rowgate.session import new_folder

END_ID, CAPACITY = 0, 2_048


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on their labels, accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that very many documents of their source share."""
    return lines.cleaned(docs, "source")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: candidates by SimHash within op5's four bits, then by
    bands and rare shingles, all checked for a likeness of 0.8 of their 5-word shingles."""
    return near_copies.one_per_group(docs, simhash.BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, CAPACITY)


STAGES = [
    ("quality", accept_quality),
    ("lines", drop_boilerplate),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Trained weights, fingerprints by XXH64 and a tokenizer's ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
