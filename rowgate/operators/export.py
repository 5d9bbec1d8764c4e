"""Exports: delimited text with a self-describing header, JSON Lines, and reject files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.session import rename_files
from rowgate.spec import TableSpec, ref


def _plain_values(rows: DataFrame, names: list[str]) -> DataFrame:
    """Columns under new names, with timestamps as the epoch milliseconds that loads read back."""
    columns = []
    for field, name in zip(rows.schema, names):
        column = ref(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_millis(column)
        columns.append(column.alias(name))
    return rows.select(*columns)


def write_delimited(
    rows: DataFrame, path: str, delimiter: str = "\t", line_end: str = "\r\n", mode: str = "errorifexists"
) -> None:
    """Quoted where needed, null as an empty field, each file headed by ``name|type|tag...`` cells.

    Cells keep every character, line ends and blanks included; an empty string is written as two
    quotes. Rows are joined to lines by column functions and written as text: the CSV writer would
    change the line feeds inside cells. The files are then named ``.csv``. Without rows there is one
    file with the header only.
    """
    spark, delimiter = rows.sparkSession, delimiter[0]
    names = TableSpec(rows.schema).header_cells()
    header = delimiter.join(_quoted_text(name, delimiter) for name in names)
    plain = _plain_values(rows, names)
    cells = [F.coalesce(_quoted_cell(ref(f.name), f.dataType, delimiter), F.lit("")) for f in plain.schema]
    written = plain.select(F.concat_ws(delimiter, *cells).alias("line"), F.monotonically_increasing_id().alias("id"))
    nth = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))  # the lower bits count the rows of a task
    most = int(spark.conf.get("spark.sql.files.maxRecordsPerFile"))
    begins_file = (nth % most if most > 0 else nth) == 0
    lines = written.select(F.when(begins_file, F.concat(F.lit(header + line_end), "line")).otherwise(F.col("line")).alias("value"))
    total = Observation()
    lines.observe(total, F.count("*").alias("n")).write.mode(mode).option("lineSep", line_end).text(path)
    if not total.get["n"]:
        spark.range(1).select(F.lit(header).alias("value")).write.mode("overwrite").option("lineSep", line_end).text(path)
    rename_files(spark, path, ".txt", ".csv")


def _quoted_cell(cell: Column, data_type: T.DataType, delimiter: str) -> Column:
    text = cell.cast("string")
    if isinstance(data_type, T.NumericType) and delimiter in "\t,;|":
        return text
    found = [F.contains(text, F.lit(mark)) for mark in (delimiter, '"', "\r", "\n")]
    marks = found[0] | found[1] | found[2] | found[3]
    return F.when(marks | (text == ""), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def _quoted_text(text: str, delimiter: str) -> str:
    needed = not text or any(mark in text for mark in (delimiter, '"', "\r", "\n"))
    return '"' + text.replace('"', '""') + '"' if needed else text


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, with null fields present."""
    _plain_values(rows, rows.columns).write.mode(mode).json(path, ignoreNullFields=False)


def write_rejects(
    rejects: DataFrame, path: str, headers: DataFrame | None = None, mode: str = "errorifexists"
) -> None:
    """Reject text per source file, below ``path/source=<file name>-<hash>``: header, then the raw
    lines in their order. Only files with rejects appear.

    Rows are spread by range of (source, place): small rejects make one file per source, a source
    with very many rejects makes several whose names sort in order. ``headers`` are the first lines
    the load has kept (``StagedLoad.headers``); without them no header is written. Rejected
    attribute records have none and go to ``source=records``.
    """
    named = F.concat(F.substring_index("file", "/", -1), F.lit("-"), F.md5("file"))
    source = F.coalesce(named, F.lit("records")).alias("source")
    lines = rejects.select("file", "block", "row", F.col("line").alias("value"))
    if headers is not None:
        before = F.lit(-1).cast("bigint")
        first = headers.join(rejects.select("file").distinct(), "file", "left_semi")
        lines = lines.union(first.select("file", before.alias("block"), before.alias("row"), F.col("header").alias("value")))
    placed = lines.select(source, "block", "row", "value")
    (
        placed.repartitionByRange("source", "block", "row")
        .sortWithinPartitions("source", "block", "row")
        .select("source", "value")
        .write.mode(mode)
        .partitionBy("source")
        .text(path, lineSep="\n")
    )
