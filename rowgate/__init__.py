"""Validated loading, keyed table writes and change export on Spark DataFrames."""

from rowgate.functions.cells import Dialect
from rowgate.functions.coerce import DateRule
from rowgate.spec import TableSpec, parse_spec

__all__ = ["DateRule", "Dialect", "TableSpec", "parse_spec"]
