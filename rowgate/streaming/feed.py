"""Change feed of a table: rows inserted after the subscription, exported trigger by trigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowgate.operators import commits
from rowgate.operators.export import write_delimited, write_json
from rowgate.operators.tables import Table
from rowgate.session import delete_folder, publish_text, read_text
from rowgate.sources.commits import read_commits

START = "rowgate-subscribed"  # below the checkpoint: the number of the last entry that is not delivered


def inserted_rows(table: Table, after: int = 0) -> DataFrame:
    """The rows that loads behind entry ``after`` inserted, as a stream in the order of the loads.
    Updates and deletes are not part of it."""
    if table.folder is None:
        raise ValueError(f"{table.name} was not declared here and has no insert log")
    return read_commits(table.spark, table.folder, table.spec.schema, after)


def subscribe(table: Table, checkpoint: str) -> int:
    """Mark everything stored so far as seen, by the number of the last entry, unless the feed of
    ``checkpoint`` has subscribed before. Returns the number at which it starts; reads no rows."""
    if table.folder is None:
        raise ValueError(f"{table.name} was not declared here and has no insert log")
    publish_text(table.spark, f"{checkpoint}/{START}", str(commits.last(table.spark, table.folder)["number"]))
    return int(read_text(table.spark, f"{checkpoint}/{START}"))


def start_delimited_feed(
    table: Table, path: str, checkpoint: str, delimiter: str = "\t", trigger: dict | None = None
) -> StreamingQuery:
    """Each trigger with new rows writes ``path/batch=<n>`` as delimited text."""

    def export(rows: DataFrame, target: str) -> None:
        write_delimited(rows, target, delimiter, mode="overwrite")

    return start_feed(table, path, checkpoint, export, trigger)


def start_json_feed(table: Table, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Each trigger with new rows writes ``path/batch=<n>`` as JSON Lines."""
    return start_feed(table, path, checkpoint, lambda rows, target: write_json(rows, target, mode="overwrite"), trigger)


def start_feed(
    table: Table, path: str, checkpoint: str, export: Callable[[DataFrame, str], None], trigger: dict | None = None
) -> StreamingQuery:
    """Drain new rows into ``export(rows, path/batch=<n>)``, from 1 on. A repeated batch overwrites its own
    folder; a trigger without rows writes nothing. Row counts are in the query's progress.

    A feed whose checkpoint is new subscribes first: what is stored so far is not delivered."""

    def drain(batch: DataFrame, batch_id: int) -> None:
        total, target = Observation(), f"{path}/batch={batch_id + 1}"
        export(batch.observe(total, F.count("*").alias("n")), target)  # the only reading, so that progress counts are right
        if not total.get["n"]:
            delete_folder(batch.sparkSession, target)

    writer = inserted_rows(table, subscribe(table, checkpoint)).writeStream.foreachBatch(drain)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
