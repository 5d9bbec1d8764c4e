"""Typing rules for one cell, strict (delimited files) and lenient (attribute records).

Each rule has two steps so that Spark evaluates the parse once: ``parse`` yields a typed candidate
column, ``judge`` turns text and candidate into the stored value and a reject reason (null if good).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.functions.cells import is_blank, trim_blanks
from rowgate.functions.dates import DateRule
from rowgate.functions.numbers import is_written_number, whole_number
from rowgate.spec import is_nullable

NULL, BAD_NUMBER, BAD_TIMESTAMP = "null", "bad_number", "bad_timestamp"


def parse(cell: Column, field: T.StructField, dates: DateRule) -> Column:
    data_type = field.dataType
    if isinstance(data_type, T.TimestampType):
        return dates.read(cell)
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        return whole_number(cell, data_type.simpleString())
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return cell.try_cast(data_type.simpleString())
    if isinstance(data_type, T.StringType):
        return trim_blanks(cell)
    raise ValueError(f"column {field.name}: cannot load into {data_type.simpleString()}")


def _value(cell: Column, candidate: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(is_written_number(cell, candidate), candidate)
    return candidate


def judge_strict(cell: Column, candidate: Column, field: T.StructField) -> tuple[Column, Column]:
    """Blank is null, null needs a nullable column, anything unreadable rejects the row."""
    blank_reason = F.lit(None).cast("string") if is_nullable(field) else F.lit(NULL)
    if isinstance(field.dataType, T.StringType):
        value = F.when(candidate != "", candidate)
        return value, F.when(value.isNull(), blank_reason)
    unreadable = BAD_TIMESTAMP if isinstance(field.dataType, T.TimestampType) else BAD_NUMBER
    value = _value(cell, candidate, field)
    reason = F.when(value.isNull(), F.when(is_blank(cell), blank_reason).otherwise(unreadable))
    return value, reason


def judge_lenient(cell: Column, candidate: Column, field: T.StructField) -> tuple[Column, Column]:
    """Absent is null, unreadable numbers are 0, strings stay untrimmed, bad dates fail the record."""
    if isinstance(field.dataType, T.StringType):
        value, reason = F.when(candidate != "", cell), F.lit(None).cast("string")
    elif isinstance(field.dataType, T.TimestampType):
        value, reason = candidate, F.when(cell.isNotNull() & candidate.isNull(), BAD_TIMESTAMP)
    else:
        zero = F.lit(0).cast(field.dataType)
        value = F.when(cell.isNotNull(), F.coalesce(_value(cell, candidate, field), zero))
        reason = F.lit(None).cast("string")
    if "key" in field.metadata:
        reason = F.coalesce(reason, F.when(value.isNull(), NULL))
    return value, reason
