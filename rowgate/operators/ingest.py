"""Whole loads: tag, stage once, write to a table, keep the rejects."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.functions.cells import Dialect
from rowgate.functions.dates import DateRule
from rowgate.operators.export import write_json, write_rejects
from rowgate.operators.load import REJECTED, StagedLoad, load_order, stage, tag_attributes, tag_lines
from rowgate.operators.tables import PENDING, Table
from rowgate.session import delete_folder, is_complete, new_folder, put_mark
from rowgate.sources.delimited import read_lines


@dataclass(frozen=True)
class LoadReport:
    load_id: str
    staged: StagedLoad

    @property
    def rejects(self) -> DataFrame:
        return self.staged.rejects

    @property
    def _mark(self) -> str:
        return f"{self.staged.path.rsplit('/', 1)[0]}/{PENDING}"

    def export_rejects(self, path: str) -> None:
        """Write the reject files of the load, whole again if some are there. A load without
        rejects writes nothing. Afterwards its working folder may go."""
        if self.staged.counts[REJECTED]:
            write_rejects(self.rejects, path, self.staged.headers, mode="overwrite")
            delete_folder(self.staged.spark, self._mark)

    def export_failed_files(self, path: str) -> None:
        """Write ``(file, rejected)`` for the files of which nothing was stored, as JSON Lines."""
        if self.staged.counts[REJECTED]:
            counted = self.rejects.groupBy("file").agg(F.count("*").alias(REJECTED))
            write_json(counted, path, mode="overwrite")


def load_files(
    spark: SparkSession,
    path: str | list[str],
    table: Table,
    dialect: Dialect = Dialect(),
    dates: DateRule = DateRule(),
    has_header: bool = True,
    skip_errors: bool = True,
    update: bool = False,
    load_id: str | None = None,
) -> LoadReport:
    """Load delimited files. Bad rows become rejects; without ``skip_errors`` they fail their file."""
    tagged = tag_lines(read_lines(spark, path, has_header), table.spec, dialect, dates)
    return load_tagged(tagged, table, skip_errors, update, load_id)


def load_records(
    records: DataFrame,
    attributes: str,
    table: Table,
    dates: DateRule = DateRule(),
    update: bool = False,
    load_id: str | None = None,
) -> LoadReport:
    """Load records given as a ``map<string,string>`` column."""
    return load_tagged(tag_attributes(records, attributes, table.spec, dates), table, True, update, load_id)


def load_tagged(
    tagged: DataFrame, table: Table, skip_errors: bool = True, update: bool = False, load_id: str | None = None
) -> LoadReport:
    """Stage a tagged load and write its accepted rows. A repeated ``load_id`` changes nothing."""
    spark = tagged.sparkSession
    load_id = load_id or uuid.uuid4().hex
    path = f"{table.work_folder(load_id)}/staged" if table.folder else new_folder(spark, "load")
    if is_complete(spark, path):
        staged = StagedLoad(spark, path, table.spec).recounted()
    else:
        staged = stage(tagged, table.spec, path)
    report = LoadReport(load_id, staged)
    if not table.holds_load(load_id):
        if table.folder and staged.counts[REJECTED]:
            put_mark(spark, report._mark)
        rows = staged.accepted if skip_errors else staged.accepted_whole_files()
        table.write(rows, load_order(), load_id, update)
    else:
        table.settle()
    return report
