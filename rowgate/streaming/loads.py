"""Continuous loads: a stream of lines or attribute records, loaded batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowgate.functions.cells import Dialect
from rowgate.functions.dates import DateRule
from rowgate.operators.ingest import load_tagged
from rowgate.operators.load import tag_attributes, tag_lines
from rowgate.operators.tables import Table
from rowgate.sources.delimited import read_lines


def start_file_load(
    spark: SparkSession,
    path: str,
    table: Table,
    checkpoint: str,
    dialect: Dialect = Dialect(),
    dates: DateRule = DateRule(),
    has_header: bool = True,
    files_per_trigger: int = 0,
    skip_errors: bool = True,
    update: bool = False,
    stream: str = "files",
    trigger: dict | None = None,
    rejects: str | None = None,
    failed_files: str | None = None,
) -> StreamingQuery:
    """Load the files of a folder as they arrive, at most ``files_per_trigger`` at a time (0: all).

    A batch with rejects writes its reject files below ``rejects/batch=<n>`` and, without
    ``skip_errors``, the names of its failed files below ``failed_files/batch=<n>``."""
    lines = read_lines(spark, path, has_header, files_per_trigger)

    def tag(batch: DataFrame) -> DataFrame:
        return tag_lines(batch, table.spec, dialect, dates)

    return _start(lines, tag, table, checkpoint, skip_errors, update, stream, trigger, rejects, failed_files)


def start_record_load(
    records: DataFrame,
    attributes: str,
    table: Table,
    checkpoint: str,
    dates: DateRule = DateRule(),
    update: bool = False,
    stream: str = "records",
    trigger: dict | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Load a stream with a ``map<string,string>`` column; cap its batches at the source
    (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``). Failed records go to ``rejects/batch=<n>``."""

    def tag(batch: DataFrame) -> DataFrame:
        return tag_attributes(batch, attributes, table.spec, dates)

    return _start(records, tag, table, checkpoint, True, update, stream, trigger, rejects, None)


def _start(
    source: DataFrame,
    tag: Callable[[DataFrame], DataFrame],
    table: Table,
    checkpoint: str,
    skip_errors: bool,
    update: bool,
    stream: str,
    trigger: dict | None,
    rejects: str | None,
    failed_files: str | None,
) -> StreamingQuery:
    """The load id is the query's own id, which its checkpoint keeps, and the batch number: a batch
    that Spark repeats is not loaded twice, and streams with checkpoints of their own never share one."""

    def load(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        report = load_tagged(tag(batch), table, skip_errors, update, load_id=f"{stream}-{query}-{batch_id}")
        if failed_files and not skip_errors:
            report.export_failed_files(f"{failed_files}/batch={batch_id}")
        if rejects:
            report.export_rejects(f"{rejects}/batch={batch_id}")

    writer = source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
