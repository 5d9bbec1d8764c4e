"""Number cells. Null means "not a number"; blanks around whole numbers are not allowed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(cell: Column, sql_type: str) -> Column:
    """Sign and ASCII digits, within the range of ``int`` or ``bigint``.

    The cast alone would also take blanks and control characters around the digits.
    """
    last = F.substring(cell, -1, 1)
    bare = (cell >= "+") & (cell < ":") & (last >= "0") & (last < ":")
    return F.when(bare, cell.try_cast(sql_type))


def is_written_number(cell: Column, parsed: Column) -> Column:
    """False for the words the cast takes beyond ``NaN`` and ``Infinity``, such as ``inf`` or ``nan``.

    ``parsed`` is the float or double cast of ``cell``; overflowing digits are a number (infinity).
    """
    finite = ~F.isnan(parsed) & (F.abs(parsed) != float("inf"))
    return parsed.isNotNull() & (finite | cell.rlike("[0-9]|NaN|Infinity"))
