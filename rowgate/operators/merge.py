"""Keyed writes as DataFrame functions. Keys are never null in accepted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.spec import ref


def one_per_key(rows: DataFrame, keys: list[str], order: Column, columns: list[str], keep: str) -> DataFrame:
    """The first or last row of each key by ``order``.

    An aggregate rather than a window: each task reduces its own rows first, so a key that holds a
    large part of the load sends one row per task over the network.
    """
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    chosen = pick(F.struct(*[ref(c) for c in columns]), order).alias("chosen")
    return rows.groupBy(*[ref(k) for k in keys]).agg(chosen).select("chosen.*")


def new_rows(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows (one per key) whose key the target does not hold.

    The target is read for its key columns only and reduced to the incoming keys first: a small load
    is broadcast against it and the target does not move; a large one shuffles both sides once.
    """
    known = target.select(*map(ref, keys)).join(incoming.select(*map(ref, keys)), keys, "left_semi")
    return incoming.join(known, keys, "left_anti").select(*map(ref, incoming.columns))


def insert_or_ignore(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The target plus the incoming rows with new keys."""
    return target.unionByName(new_rows(target, incoming, keys))


def insert_or_update(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The target with the incoming rows (one per key) in place of, or added to, its own."""
    kept = target.join(incoming.select(*map(ref, keys)), keys, "left_anti")
    return kept.select(*map(ref, target.columns)).unionByName(incoming)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the columns, order and types of a stored schema; a failing cast fails the job."""
    return rows.select(*[ref(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])
