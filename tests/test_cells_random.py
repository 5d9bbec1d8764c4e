"""The column expressions against a character-by-character reading of the same grammar."""

import random

import pytest

from rowgate import Dialect
from pyspark.sql import functions as F

CONTROL = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def read_line(line, delimiter, quote, escape):
    """Cells of a line, or None when it is malformed."""
    cells, i = [], 0

    def escaped(at):
        if at + 1 >= len(line):
            raise ValueError
        c = line[at + 1]
        if c in CONTROL:
            return CONTROL[c]
        return c if c in (delimiter, quote, escape) or c in CONTROL.values() else escape + c

    try:
        while True:
            text = ""
            if quote and line[i : i + 1] == quote:
                i += 1
                while True:
                    c = line[i]
                    if escape and c == escape:
                        text += escaped(i)
                        i += 2
                    elif c == quote and line[i + 1 : i + 2] == quote:
                        text += quote
                        i += 2
                    elif c == quote:
                        i += 1
                        break
                    else:
                        text += c
                        i += 1
                while i < len(line) and line[i] != delimiter:
                    if not line[i].isspace():
                        return None
                    i += 1
            else:
                while i < len(line) and line[i] != delimiter:
                    if escape and line[i] == escape:
                        text += escaped(i)
                        i += 2
                    else:
                        text += line[i]
                        i += 1
            cells.append(text)
            if i >= len(line):
                return cells
            i += 1
    except (IndexError, ValueError):
        return None


@pytest.mark.parametrize(
    "delimiter, quote, escape",
    [(",", '"', '"'), ("\t", '"', '"'), ("|", "'", "\\"), (",", '"', "\\"), (";", "", "\\"), ("$", "$$"[:0], '"'), ("^", "$", "$"), (".", "*", "^")],
)
def test_random_lines(spark, delimiter, quote, escape):
    rng = random.Random(delimiter + quote + escape)
    dialect = Dialect(delimiter, quote, escape)
    alphabet = [delimiter, quote, escape, quote, delimiter, " ", "\t", "a", "n", "é", "\U0001f600", "x y", "$1", "\\"]
    lines = ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(4000)]
    lines = [line for line in lines if line]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    found = df.select("i", dialect.is_malformed(F.col("line")).alias("bad"), dialect.split(F.col("line")).alias("cells"))
    seen = set()
    for row in found.collect():
        expected = read_line(lines[row.i], delimiter, dialect.quote, dialect.escape)
        assert row.bad == (expected is None), lines[row.i]
        assert expected is None or row.cells == expected, lines[row.i]
        seen.add(expected is None)
    assert seen == ({True, False} if dialect.quote or dialect.escape else {False})
