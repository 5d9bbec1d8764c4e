"""Date cells: pattern preparation and the two readings (epoch milliseconds, pattern and zone)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowgate.functions.cells import trim_blanks

_LAST_MILLISECOND = (2**63 - 1) // 1000  # the last one a microsecond timestamp can hold
_PATTERN_PART = re.compile(r"'[^']*'|([A-Za-z])\1*|[^A-Za-z']+")

_DAY_MILLIS = 86_400_000
_MOST_MONTHS = 294_248 * 12  # the years a microsecond timestamp can hold

# Pattern letters that stand for a zone written in the text itself.
_ZONE_LETTERS = set("zZXxOV")
# Weekday names, short or long.
_WEEKDAYS = "mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?"


@dataclass(frozen=True)
class DateRule:
    """How a timestamp cell is read.

    ``zone`` is the zone of the written wall-clock times; without one they are in the session zone.
    Out-of-range fields and text after the date make a cell unreadable; blanks around it do not.
    With ``lenient``, fields roll over (month 13 is January of the next year) and text after the date
    is ignored; patterns are then limited to numbers and the am/pm marker.

    Either way a two-digit year is one of the years from 80 before to 20 after today. A 12-hour
    field without an am/pm marker is on the 24-hour clock, but 12 is midnight. A weekday may begin a
    date (not a lenient one); it must be a weekday's English name but need not be the right one.
    """

    pattern: str | None = None
    zone: str | None = None
    lenient: bool = False

    def __post_init__(self) -> None:
        if self.pattern is None:
            return
        if self.lenient:
            _lenient_layout(self.pattern)
        elif "E" in _letters(_weekday_and_rest(self.pattern)[1]):
            raise ValueError(f"a weekday can only begin a date: {self.pattern!r}")
        elif _bare_twelve_hours(self.pattern) and _ZONE_LETTERS & _letters(self.pattern):
            raise ValueError(f"a 12-hour field beside a zone needs an am/pm marker: {self.pattern!r}")

    def read(self, cell: Column) -> Column:
        """Timestamp, or null when unreadable. Text of ASCII digits is epoch milliseconds as is."""
        millis = F.coalesce(cell.try_cast("bigint"), F.lit(0))
        instant = F.when(millis <= _LAST_MILLISECOND, F.timestamp_millis(millis))
        return F.when(cell.rlike(r"^[0-9]++\z"), instant).otherwise(self._read_written(cell))

    def _read_written(self, cell: Column) -> Column:
        if self.pattern is None:
            return F.lit(None).cast("timestamp")
        if self.lenient:
            return F.to_utc_timestamp(_roll_over(cell, self.pattern), F.lit(self.zone) if self.zone else F.current_timezone())
        cell = trim_blanks(cell)
        weekday, rest = _weekday_and_rest(self.pattern)
        if weekday:
            begins = f"(?i)^({_WEEKDAYS})(?![a-z])"
            cell = F.when(cell.rlike(begins), F.regexp_replace(cell, begins, ""))
        pattern = spark_pattern(rest)
        written = F.try_to_timestamp(cell, F.lit(pattern)).cast("timestamp")
        if {"y", "yy"} & set(_pattern_parts(rest)):
            written = _near_century(written, "yy" in _pattern_parts(pattern))
        if _bare_twelve_hours(rest):
            written = F.when(F.hour(written) == 12, written - F.expr("INTERVAL 12 HOURS")).otherwise(written)
        if self.zone is None or _ZONE_LETTERS & _letters(rest):
            return written
        return F.to_utc_timestamp(written, self.zone)


def _pattern_parts(pattern: str) -> list[str]:
    return [m[0] for m in _PATTERN_PART.finditer(pattern)]


def _letters(pattern: str) -> set[str]:
    """The pattern letters, without quoted text."""
    return {part[0] for part in _pattern_parts(pattern) if part[0].isalpha()}


def _bare_twelve_hours(pattern: str) -> bool:
    """Whether there is a 12-hour field and no am/pm marker."""
    return "h" in _letters(pattern) and "a" not in _letters(pattern)


def _weekday_and_rest(pattern: str) -> tuple[str, str]:
    """The weekday field that begins the pattern, if one does, and what follows it."""
    found = re.match("E*", pattern)[0]
    return found, pattern[len(found) :]


def _first_near_year() -> Column:
    return F.year(F.current_date()) - 80


def _near_century(written: Column, as_20xx: bool) -> Column:
    """A two-digit year, read as 20xx or else as it was written, near today."""
    year, since = F.year(written), _first_near_year()
    last_two = F.pmod(year, F.lit(100))
    wanted = since - since % 100 + last_two + F.when(last_two < since % 100, 100).otherwise(0)
    two_digits = year.between(2000, 2099) if as_20xx else year < 100
    return F.when(two_digits, written + F.make_interval(years=wanted - year)).otherwise(written)


def spark_pattern(pattern: str) -> str:
    """The given date pattern with field widths relaxed to what its author means.

    A field set off by separators may be written with fewer digits than letters, so it becomes a
    single letter; fields that touch each other keep their widths, as do fractions and
    month names. A 12-hour field without an am/pm marker is read by the 24-hour clock.
    """
    parts = _pattern_parts(pattern)
    has_marker = any(p[0] == "a" for p in parts)
    relaxed = []
    for before, part, after in zip([""] + parts, parts, parts[1:] + [""]):
        if part[0] == "h" and not has_marker:
            part = "H" * len(part)
        touches = before[:1].isalpha() or after[:1].isalpha()
        numeric = part[0] in "dHhms" or part in ("MM", "yyyy", "yyy", "yy")
        relaxed.append(part[0] if numeric and not touches else part)
    return "".join(relaxed)


def _lenient_layout(pattern: str) -> tuple[str, dict[str, int], dict[str, int]]:
    """A regex with one group per field, and the group number and letter count of each field letter.

    A field that touches the next one takes no more digits than it has letters.
    """
    parts = _pattern_parts(pattern)
    regex, groups, counts = "^", {}, {}
    for part, after in zip(parts, parts[1:] + [""]):
        letter = part[0]
        if not letter.isalpha():
            text = part if letter != "'" else part[1:-1] or "'"
            regex += "".join(f"\\x{{{ord(c):x}}}" for c in text)
            continue
        if letter not in "yMdHhkKmsSa" or letter in groups or (letter == "M" and len(part) > 2):
            raise ValueError(f"lenient dates cannot read {part!r} in pattern {pattern!r}")
        touches = after[:1].isalpha() and after[:1] != "a"
        most = len(part) if touches else 18  # longer numbers are beyond every timestamp
        zeros = "" if touches else "0*?"  # any number of zeros in front of a number
        regex += "[ \\t]*+" + ("([AaPp][Mm])" if letter == "a" else f"{zeros}([0-9]{{1,{most}}}+)")
        groups[letter], counts[letter] = len(groups) + 1, len(part)
    return regex, groups, counts


def _roll_over(cell: Column, pattern: str) -> Column:
    """The wall-clock time of a cell as a timestamp in UTC: fields are added up, not checked.

    One replacement takes all fields out of the cell; the lambda gives their array a name, so that
    no field is sought again where it is used twice."""
    regex, groups, counts = _lenient_layout(pattern)
    fields = F.split(F.regexp_replace(cell, regex + r"[\s\S]*+\z", "\x01".join(f"${i}" for i in groups.values())), "\x01")
    found = F.get(F.transform(F.array(fields), lambda f: _added_up(f, groups, counts)), 0)
    return F.when(cell.rlike(regex), found)


def _added_up(fields: Column, groups: dict[str, int], counts: dict[str, int]) -> Column:
    def field(letter: str) -> Column:
        return F.get(fields, groups[letter] - 1)

    def number(letter: str, default: int = 0) -> Column:
        return field(letter).cast("bigint") if letter in groups else F.lit(default).cast("bigint")

    def millis(count: Column, unit: int) -> Column:
        return F.least(count, F.lit(10**16 // unit)) * unit  # enough to be beyond every timestamp

    year = number("y", 1970)
    if counts.get("y", 4) <= 2:  # two digits stand for the years from 80 before to 20 after today
        since = _first_near_year()
        near = since - since % 100 + year + F.when(year < since % 100, 100).otherwise(0)
        year = F.when(F.length(field("y")) == 2, near).otherwise(year)
    months = F.least(year, F.lit(_MOST_MONTHS)) * 12 + F.least(number("M", 1), F.lit(_MOST_MONTHS)) - 1
    inside = F.when(months < _MOST_MONTHS, months)
    first = F.make_date(F.floor(inside / 12).cast("int"), (F.pmod(inside, F.lit(12)) + 1).cast("int"), F.lit(1))
    days = F.unix_date(first).cast("bigint") - 1
    twelve, twenty_four = number("h"), number("k")
    hours = number("H") + number("K") + F.when(twelve == 12, 0).otherwise(twelve)
    hours += F.when(twenty_four == 24, 0).otherwise(twenty_four)
    if "a" in groups:
        hours += F.when(F.upper(field("a")) == "PM", 12).otherwise(0)
    total = days * _DAY_MILLIS + millis(number("d", 1), _DAY_MILLIS) + millis(hours, 3_600_000)
    total += millis(number("m"), 60_000) + millis(number("s"), 1000) + millis(number("S"), 1)
    return F.when(total <= _LAST_MILLISECOND, F.timestamp_millis(total))
