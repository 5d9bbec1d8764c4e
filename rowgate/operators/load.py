"""Tagging loads: every input row becomes one typed row plus a ``_load`` struct that says what
happened to it.

``_load`` holds ``reason``, ``field`` and ``line``, the raw text, (all null when accepted), ``file``,
``block`` and ``row``; the last three order the rows of a load. Header lines are kept with the
reason ``header``, so that reject files can begin with them without reading the input again. Nothing here shuffles except the
whole-file rule and the counts, and those only shuffle one row per file and task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.functions import coerce
from rowgate.functions.cells import Dialect
from rowgate.functions.dates import DateRule
from rowgate.operators.joins import listed_join
from rowgate.session import new_folder, require_utc
from rowgate.spec import LOAD_COLUMN, TableSpec, ref

MALFORMED, ARITY = "malformed", "arity"
HEADER = "header"  # the reason of header lines, which are neither accepted nor rejected
ACCEPTED, REJECTED = "accepted", "rejected"

LOAD_TYPE = T.StructType()
for _name in ("reason", "field", "line", "file"):
    LOAD_TYPE.add(_name, T.StringType())
for _name in ("block", "row"):
    LOAD_TYPE.add(_name, T.LongType())

Judge = Callable[[Column, Column, T.StructField], tuple[Column, Column]]


def tag_lines(
    lines: DataFrame, spec: TableSpec, dialect: Dialect = Dialect(), dates: DateRule = DateRule()
) -> DataFrame:
    """Tag the rows of ``sources.delimited.read_lines``. The first rule that fails gives the reason:
    malformed line, wrong number of cells, then the cells from left to right. A line of nothing but
    blanks is one blank cell."""
    if dates.zone:
        require_utc(lines.sparkSession)
    is_header = F.col("header") if "header" in lines.columns else F.lit(False)
    cells = lines.select(
        "line",
        "file",
        "block",
        is_header.alias("header"),
        dialect.is_malformed(F.col("line")).alias("malformed"),
        dialect.split(F.col("line")).alias("cells"),
    )
    width = len(spec.names)
    line_reason = F.when(F.col("header"), HEADER).when(F.col("malformed"), MALFORMED).when(F.size("cells") != width, ARITY)
    texts = [F.get("cells", F.lit(i)) for i in range(width)]
    return _tag(cells, "line", F.col("line"), texts, spec, dates, coerce.judge_strict, line_reason)


def tag_attributes(
    records: DataFrame, attributes: str, spec: TableSpec, dates: DateRule = DateRule()
) -> DataFrame:
    """Tag records given as a ``map<string,string>`` column: columns are picked by exact name, other
    keys are ignored, absent keys are null. A failed record keeps its map as JSON in ``line``."""
    if dates.zone:
        require_utc(records.sparkSession)
    placed = records.select(
        ref(attributes).alias("attributes"),
        F.lit(None).cast("string").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
    )
    texts = [F.element_at("attributes", F.lit(name)) for name in spec.names]
    return _tag(placed, "attributes", F.to_json("attributes"), texts, spec, dates, coerce.judge_lenient, None)


def _tag(
    rows: DataFrame,
    raw: str,
    text_of: Column,
    texts: list[Column],
    spec: TableSpec,
    dates: DateRule,
    judge: Judge,
    line_reason: Column | None,
) -> DataFrame:
    fields = list(spec.schema)
    facts = [raw, "file", "block"]
    reason = [] if line_reason is None else [line_reason]
    picked = rows.select(
        *facts,
        F.coalesce(*reason, F.lit(None).cast("string")).alias("line_reason"),
        *[text.alias(f"text_{i}") for i, text in enumerate(texts)],
    )
    parsed = picked.select(
        "*", *[coerce.parse(F.col(f"text_{i}"), field, dates).alias(f"candidate_{i}") for i, field in enumerate(fields)]
    )
    judged = [judge(F.col(f"text_{i}"), F.col(f"candidate_{i}"), field) for i, field in enumerate(fields)]
    valued = parsed.select(
        *facts,
        "line_reason",
        *[value.alias(f"value_{i}") for i, (value, _) in enumerate(judged)],
        *[bad.alias(f"reason_{i}") for i, (_, bad) in enumerate(judged)],
    )
    cell_reasons = [F.col(f"reason_{i}") for i in range(len(fields))]
    bad_field = F.coalesce(*[F.when(r.isNotNull(), F.lit(f.name)) for r, f in zip(cell_reasons, fields)])
    reasoned = valued.select(
        *[F.col(f"value_{i}") for i in range(len(fields))],
        *facts,
        F.coalesce("line_reason", *cell_reasons).alias("reason"),
        F.when(F.col("line_reason").isNull(), bad_field).alias("field"),
    )
    load = F.struct(
        "reason",
        "field",
        F.when(F.col("reason").isNotNull(), text_of).alias("line"),
        "file",
        "block",
        F.monotonically_increasing_id().alias("row"),
    )
    return reasoned.select(
        *[F.col(f"value_{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(fields)],
        load.alias(LOAD_COLUMN),
    )


def is_accepted() -> Column:
    return F.col(f"{LOAD_COLUMN}.reason").isNull()


def is_rejected() -> Column:
    return F.col(f"{LOAD_COLUMN}.reason") != HEADER


def load_order() -> Column:
    """Sort key of the rows of one load: file by file, top to bottom."""
    return F.struct(*[F.col(f"{LOAD_COLUMN}.{part}") for part in ("file", "block", "row")])


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(is_accepted()).drop(LOAD_COLUMN)


def rejects(tagged: DataFrame) -> DataFrame:
    return tagged.where(is_rejected()).select(f"{LOAD_COLUMN}.*")


def headers(tagged: DataFrame) -> DataFrame:
    """``(file, header)``: the first line of each file of a load with headers."""
    return tagged.where(F.col(f"{LOAD_COLUMN}.reason") == HEADER).select(
        F.col(f"{LOAD_COLUMN}.file").alias("file"), F.col(f"{LOAD_COLUMN}.line").alias("header")
    )


def load_counts(tagged: DataFrame) -> DataFrame:
    """``(file, accepted, rejected)``, pre-aggregated in every task."""
    return tagged.groupBy(F.col(f"{LOAD_COLUMN}.file").alias("file")).agg(
        F.count_if(is_accepted()).alias(ACCEPTED),
        F.count_if(is_rejected()).alias(REJECTED),
    )


@dataclass(frozen=True)
class StagedLoad:
    """A tagged load written once, so that accepted rows and rejects cost one parse together.

    Both sides are column reads of the same files: accepted rows skip the load facts, rejects skip
    the typed columns, and pages without a reason are passed over by the pushed-down filter. Separate
    folders would need a sort of every row by its status.
    """

    spark: SparkSession
    path: str
    spec: TableSpec
    counts: dict[str, int] | None = None

    @property
    def tagged(self) -> DataFrame:
        schema = T.StructType(list(self.spec.schema)).add(LOAD_COLUMN, LOAD_TYPE)
        return self.spark.read.schema(schema).parquet(self.path)

    @property
    def accepted(self) -> DataFrame:
        """Accepted rows with ``_load`` still there, for ordering."""
        return self.tagged.where(is_accepted())

    @property
    def rejects(self) -> DataFrame:
        return rejects(self.tagged)

    @property
    def headers(self) -> DataFrame:
        return headers(self.tagged)

    def recounted(self) -> StagedLoad:
        """The same load with its counts taken again from the written rows."""
        totals = self.tagged.agg(F.count_if(is_accepted()).alias(ACCEPTED), F.count_if(is_rejected()).alias(REJECTED)).first()
        return StagedLoad(self.spark, self.path, self.spec, totals.asDict())

    @property
    def failed_files(self) -> DataFrame:
        """The files with at least one reject: without ``skip_errors``, nothing of them is stored."""
        return self.rejects.select("file").distinct()

    def accepted_whole_files(self) -> DataFrame:
        """Accepted rows of the files that have no reject: one bad row fails its whole file."""
        rows, name = self.accepted, "_file"
        while name in rows.columns:
            name += "_"
        rows = rows.withColumn(name, F.col(f"{LOAD_COLUMN}.file"))
        return listed_join(rows, self.failed_files.toDF(name), [name], "left_anti").drop(name)


def stage(tagged: DataFrame, spec: TableSpec, path: str | None = None) -> StagedLoad:
    """Write a tagged load."""
    spark = tagged.sparkSession
    path = path or new_folder(spark, "load")
    totals = Observation()
    counted = tagged.observe(totals, F.count_if(is_accepted()).alias(ACCEPTED), F.count_if(is_rejected()).alias(REJECTED))
    counted.write.mode("overwrite").parquet(path)
    return StagedLoad(spark, path, spec, dict(totals.get))
