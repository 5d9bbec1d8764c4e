"""Registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rowgate.llm import decontaminate, lines, manifest, merkle, negatives, packed_ids, packing, quality, repeats, revisits, secrets, simhash, topk
from rowgate.llm.common import table
from rowgate.llm.oracles import ORACLES  # noqa: F401

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "rowgate.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(os.path.join(top, "rowgate")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, top))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_ids.packed_documents(spark, table(spark, sf_dir, "documents"), path, end_id=2, vocabulary=49_408)


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.revisit_report(table(spark, sf_dir, "pages"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=0, capacity=2_048)


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proof_report(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": _op1,
    "op2_packed_ids": _op2,
    "op3_revisits": _op3,
    "op4_secrets": _op4,
    "op5_simhash": _op5,
    "op6_quality": _op6,
    "op7_lines": _op7,
    "op8_repeats": _op8,
    "op9_merkle": _op9,
    "op10_packing": _op10,
    "op11_manifest": _op11,
    "op12_negatives": _op12,
    "op13_topk": _op13,
    "pipeline": corpus_pipeline.run,
}


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        run.__doc__ = query.__doc__
        return run

    return {name: shipped(query) for name, query in _QUERIES.items()}
