"""The few table functions beside loading and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.operators.joins import listed_join
from rowgate.session import new_folder
from rowgate.spec import ref


def groupby_having(rows: DataFrame, keys: list[str], aggregates: list[Column], having: Column) -> DataFrame:
    return rows.groupBy(*map(ref, keys)).agg(*aggregates).where(having)


def percentile(rows: DataFrame, group: str, value: str, fraction: float) -> DataFrame:
    """``(group, percentile)``, exact and interpolated, without holding a group in one task.

    Equal values are counted first and the distinct ones spread by range over all tasks, one folder
    per range. Totals per range tell which ranges hold a wanted rank; only those are read again and
    ranked value by value, each on its own.
    """
    spark = rows.sparkSession
    spread_path, wanted_path = new_folder(spark, "ranges"), new_folder(spark, "wanted")
    (
        rows.where(ref(value).isNotNull())
        .groupBy(ref(group).alias("g"), ref(value).cast("double").alias("v"))
        .agg(F.count("*").alias("n"))
        .repartitionByRange("g", "v")
        .withColumn("part", F.spark_partition_id())
        .write.partitionBy("part")
        .parquet(spread_path)
    )
    group_type = rows.schema[group].dataType.simpleString()
    spread = spark.read.schema(f"g {group_type}, v double, n bigint, part int").parquet(spread_path)
    by_group = Window.partitionBy("g")
    (
        spread.groupBy("g", "part")
        .agg(F.sum("n").alias("inside"))
        .withColumn("before", F.sum("inside").over(by_group.orderBy("part")) - F.col("inside"))
        .withColumn("position", (F.sum("inside").over(by_group) - 1) * F.lit(fraction))
        .withColumn("low", F.floor("position"))
        .withColumn("high", F.ceil("position"))
        .where(_covers("low", "before", "inside") | _covers("high", "before", "inside"))
        .write.parquet(wanted_path)
    )
    wanted = spark.read.parquet(wanted_path)
    parts = [row.part for row in wanted.select("part").distinct().collect()]  # at most one per range
    before_value = F.sum("n").over(Window.partitionBy("g", "part").orderBy("v")) - F.col("n")
    ranked = spread.where(F.col("part").isin(parts)).join(wanted, ["g", "part"])
    ranked = ranked.withColumn("before", F.col("before") + before_value)
    low = F.max(F.when(_covers("low", "before", "n"), F.col("v")))
    high = F.max(F.when(_covers("high", "before", "n"), F.col("v")))
    weight = F.max(F.col("position") - F.col("low"))
    return ranked.groupBy(F.col("g").alias(group)).agg((low + (high - low) * weight).alias("percentile"))


def _covers(rank: str, before: str, size: str) -> Column:
    """Whether the 0-based rank falls among ``size`` values that have ``before`` others below them."""
    return (F.col(rank) >= F.col(before)) & (F.col(rank) < F.col(before) + F.col(size))


def filter_by_list(rows: DataFrame, column: str, values: list | DataFrame, not_in_list: bool = False) -> DataFrame:
    """Rows whose value is listed, or (``not_in_list``) not listed. Null values are in neither.

    The list may be a one-column DataFrame; it is broadcast only when its counted size allows it.
    """
    if isinstance(values, DataFrame):
        present = rows.where(ref(column).isNotNull())
        listed = values.toDF(column).where(ref(column).isNotNull()).distinct()
        return listed_join(present, listed, [column], "left_anti" if not_in_list else "left_semi")
    listed = ref(column).isin(values)
    return rows.where(~listed if not_in_list else listed)


def page_records(rows: DataFrame, key: str | list[str], after, size: int) -> DataFrame:
    """One page in key order, starting behind ``after`` (None: the first page), with a flag for
    "there are more".

    The key is a column or an ordered list of columns, ``after`` its value or values. It must be
    unique: rows with the key of the last row of a page would not be on the next one. Reads one row
    more than the page; tasks keep at most that many, and no offset is skipped over.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if after is not None:
        last = [after] if isinstance(key, str) else list(after)
        behind, same = F.lit(False), F.lit(True)
        for name, value in zip(keys, last, strict=True):
            behind = behind | (same & (ref(name) > F.lit(value)))
            same = same & (ref(name) == F.lit(value))
        rows = rows.where(behind)
    place_name = _free_name("_place", rows)
    window = rows.orderBy(*map(ref, keys)).limit(size + 1)
    place = F.row_number().over(Window.orderBy(*map(ref, keys)))
    more = F.count("*").over(Window.partitionBy()) > size
    numbered = window.select("*", place.alias(place_name), more.alias("has_more"))
    return numbered.where(F.col(place_name) <= size).drop(place_name)


def number_pages(rows: DataFrame, key: str | list[str], size: int) -> DataFrame:
    """All rows with the number of their ``page``, from 0, of ``size`` rows each in key order.

    Rows are sorted by ranges of the key, and one count a range tells where it begins, so no task
    numbers them all. Rows of equal keys follow each other in any order.
    """
    keys, spark = [key] if isinstance(key, str) else list(key), rows.sparkSession
    place, part = _free_name("_place", rows), _free_name("_part", rows)
    path = new_folder(spark, "pages")
    ordered = rows.repartitionByRange(*map(ref, keys)).sortWithinPartitions(*map(ref, keys))
    ordered.withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn(part, F.shiftright(place, 33))
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(part)) - F.col("n")  # a row for each range
    starts = counts.select(part, before.alias("before"))
    number = F.col("before") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, part).select(*map(ref, rows.columns), F.floor(number / size).alias("page"))


def _free_name(wanted: str, rows: DataFrame) -> str:
    while wanted in rows.columns:
        wanted += "_"
    return wanted
