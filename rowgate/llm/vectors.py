"""Whole-number vectors, and a grid of blocks on which queries meet all rows.

Rows are dealt into groups of about ``GROUP`` and queries into blocks of about ``BLOCK``, by hash,
so a common vector or label is spread. Each cell of the grid is one group and one block; both sides
are sent to the cells they belong to. A cell is bounded for any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import shuffle_partitions, stored

GROUP, BLOCK = 4_096, 2_048
LARGEST = 1 << 28  # sums over up to 127 dimensions of products of such numbers fit 64 bits
NO_ID = np.iinfo(np.int64).max


def whole_vectors(rows: DataFrame, factor: int, *others) -> DataFrame:
    """``row`` (a number for each row), ``vec_id``, ``dim``, ``vector`` and ``others``.

    ``vector`` has ``floor(factor * x)`` for each component. Left out are rows whose vector is null or
    holds a component that is null, not finite, or of ``LARGEST`` and more after that."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("int"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST / factor))
    kept = rows.where(F.col("embedding").isNotNull() & F.coalesce(usable, F.lit(False)))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("vector"), *others)
    numbered = kept.select(F.monotonically_increasing_id().alias("row"), "*", F.size("vector").alias("dim"))
    return stored(numbered, "vectors")


def matrix(table: pa.Table, dim: int) -> np.ndarray:
    """The ``vector`` column as 64-bit numbers, a row for each vector."""
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, dim)


def ids(table: pa.Table) -> np.ndarray:
    """``vec_id``, the largest number for null, by which ties are put in order."""
    return table.column("vec_id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def arrow_ids(column: np.ndarray) -> pa.Array:
    return pa.array(column, pa.int64(), mask=column == NO_ID)


def on_grid(queries: DataFrame, rows: DataFrame, meet: Callable[[pa.Table, pa.Table], pa.Table], names: list[str]) -> DataFrame:
    """``meet(block of queries, group of rows)``, columns of long numbers, for all cells of one ``dim``."""
    n = shuffle_partitions(rows.sparkSession)
    groups, blocks = max(1, -(-rows.count() // GROUP)), max(1, -(-queries.count() // BLOCK))
    def dealt(side: DataFrame, place: str, of: int, every: str, number: int) -> DataFrame:
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))
        side = side.toDF(*side.columns)  # both sides may come from one table
        return side.select("*", F.pmod(F.xxhash64("row"), F.lit(of)).alias(place), F.explode(numbers).alias(every))

    sent, held = dealt(queries, "of", blocks, "to", groups), dealt(rows, "to", groups, "of", blocks)
    cell = ["dim", "of", "to"]
    one, other = (side.repartition(n, *cell).groupBy(*cell) for side in (sent, held))
    empty = pa.schema([(name, pa.int64()) for name in names])

    def run(block: pa.Table, group: pa.Table) -> pa.Table:
        return meet(block, group) if block.num_rows and group.num_rows else empty.empty_table()

    return one.cogroup(other).applyInArrow(run, ", ".join(f"{name} long" for name in names))
