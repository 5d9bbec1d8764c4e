"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns an operator reads: ``doc_id`` and ``text``, null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores added until no column has that name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: a lost executor or a second
    use does not compute it again."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """``(id, component)`` for each id in ``links(a, b)``; a component is named by its smallest id.

    Every round takes the smallest label among a vertex and its neighbours, then the label of that
    label, so paths shrink by more than half. Both joins are plain equi-joins whose large side
    adaptive execution may split, and minima are taken in each task first, so a vertex with very
    many links is no hot group. Each round is written to the shared checkpoint folder.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(links.where("a <> b").select(F.inline(ways)).distinct(), "links")  # links are computed once
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        moved = stored(
            step.join(jump, "next").select("id", F.least("next", "far").alias("component"), (F.col("far") < F.col("component")).alias("moved")),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"labels still move after {rounds} rounds")
