"""Input files for the registered queries, rendered by Spark from the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.session import new_folder

EVENT_SPEC = "event_id|long|$primary_key,user_id|long,event_type|string|nullable,value|double,ts|long|timestamp"
EVENT_HEADER = "event_id,user_id,event_type,value,ts"
EVENT_DATES = "yyyy/MM/dd HH:mm:ss"
EVENT_FILES = 8
ROWS_PER_FILE = 1_000_000

_RENDERED: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rendered(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of a rendered input, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _RENDERED:
        folder = new_folder(spark, name)
        write(folder)
        _RENDERED[key] = folder
    return _RENDERED[key]


def write_lines(rows: DataFrame, folder: str, header: str | None = None) -> None:
    """Write the ``line`` column as text files that each begin with ``header``, other columns as
    folders. The CSV writer is used for its header; separator and quote occur in no line."""
    named = rows.withColumnRenamed("line", header or "line")
    others = [c for c in rows.columns if c != "line"]
    named.write.partitionBy(*others).csv(
        folder,
        header=header is not None,
        sep="￿",
        quote="￾",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_text(rows: DataFrame, folder: str, header: str | None = None) -> None:
    """Write the ``line`` column, line feeds inside it and all, as text files that begin with ``header``."""
    begins_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.when(begins_file, F.concat(F.lit(f"{header}\n"), "line")).otherwise(F.col("line")) if header else F.col("line")
    rows.select(line.alias("value")).write.text(folder)


def cells(*columns: Column | str) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]


def event_files(spark: SparkSession, sf_dir: str, broken: bool = True) -> str:
    """Events as comma files, ``event_id % 8`` to a file and at most a million rows in one.

    ``broken`` spoils rows by ``event_id % 50`` in every way the load distinguishes; otherwise only
    the rows with remainder 17 have an unreadable number.
    """
    r = F.col("event_id") % 50
    user = F.when(r == 13, " ").otherwise(F.col("user_id").cast("string"))
    kind = (
        F.when(r == 37, '"open').when(r == 29, "\t  ").when(r == 31, '"  a,""b  "').otherwise(F.col("event_type"))
    )
    value = F.when(r == 17, "abc").otherwise(F.col("value").cast("string"))
    written = F.date_format("ts", EVENT_DATES)
    ts = (
        F.when(r == 19, "not-a-date")
        .when(r == 23, (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).cast("string"))
        .otherwise(written)
    )
    full = F.concat_ws(",", *cells("event_id", user, kind, value, ts))
    line = (
        F.when(r == 7, F.concat_ws(",", *cells("event_id", user, kind, value)))
        .when(r == 11, F.concat(full, F.lit(",x")))
        .otherwise(full)
    )
    if not broken:
        line = F.concat_ws(",", *cells("event_id", "user_id", "event_type", value, written))

    def write(folder: str) -> None:
        events = table(spark, sf_dir, "events").select(
            (F.col("event_id") % EVENT_FILES).alias("bucket"),
            F.floor(F.col("event_id") / (EVENT_FILES * ROWS_PER_FILE)).alias("chunk"),
            "event_id",
            line.alias("line"),
        )
        files = events.repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", "event_id")
        write_lines(files.drop("event_id"), folder, EVENT_HEADER)

    return rendered(spark, sf_dir, "events-broken" if broken else "events-17", write)


def delimited(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    source: str,
    columns: list[Column | str],
    delimiter: str = ",",
    header: bool = True,
) -> str:
    """A whole table as delimited files, one per input partition."""

    def write(folder: str) -> None:
        line = F.concat_ws(delimiter, *cells(*columns)).alias("line")
        heading = delimiter.join(["h"] * len(columns)) if header else None
        write_lines(table(spark, sf_dir, source).select(line), folder, heading)

    return rendered(spark, sf_dir, name, write)


def attribute_records(
    spark: SparkSession, sf_dir: str, name: str, source: str, entries: dict[str, Column], keys: dict[str, Column] | None = None
) -> str:
    """A whole table as Parquet records with one map column ``attrs`` of name -> text.

    A null text leaves the entry out; ``keys`` gives some entries another name, row by row.
    """
    names = {n: F.lit(n) for n in entries} | (keys or {})
    pairs = F.array(*[F.struct(names[n].alias("key"), text.cast("string").alias("value")) for n, text in entries.items()])
    present = F.filter(pairs, lambda pair: pair["value"].isNotNull())

    def write(folder: str) -> None:
        rows = table(spark, sf_dir, source).repartition(spark.sparkContext.defaultParallelism)
        rows.select(F.map_from_entries(present).alias("attrs")).write.parquet(folder)

    return rendered(spark, sf_dir, name, write)
