"""Physical lines of delimited files, with their file and place, for batch and streaming loads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession, path: str | list[str], has_header: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """One row ``(line, file, block)`` per physical line, empty ones included.

    Large files are split. With headers there is a fourth column, ``header``, true for the first
    physical line of each file (empty or not). Pass ``files_per_trigger`` (0 for no cap) to get a
    streaming DataFrame.

    Only the task that reads the first block of a file can see its first line, and no column
    function knows where a block begins among the rows of a task; so lines of files with headers
    pass through one Arrow step. It holds one batch at a time and neither shuffles nor reads again.
    """
    reader = spark.read if files_per_trigger is None else spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.schema("value string").option("recursiveFileLookup", True).text(path)
    lines = raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines.mapInArrow(_mark_headers, "line string, file string, block bigint, header boolean") if has_header else lines


def _mark_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flag the rows that begin a file: block 0, and the row before is of another file or block."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block")
        changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        begins = pa.array([before != (file[0].as_py(), block[0].as_py())])
        begins = pa.concat_arrays([begins, changed])
        before = (file[-1].as_py(), block[-1].as_py())
        header = pc.and_(begins, pc.equal(block, 0))
        yield pa.RecordBatch.from_arrays([*batch.columns, header], names=[*batch.schema.names, "header"])
