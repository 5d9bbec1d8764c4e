"""The ordered log of a table: entries numbered from 1, each created only if it is absent.

An entry holds the load, the folder of the rows it inserted, the buckets it touched and, for tables
with a key, the folders that make up every bucket from then on. Whoever creates entry n+1 has seen
entry n; a load that finds its number taken looks at what the other one touched and tries again.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from rowgate.session import publish_text, put_text, read_text

START = {"number": 0, "load": "", "inserted": [], "touched": [], "live": {}}


def path_of(folder: str, number: int) -> str:
    return f"{folder}/commits/{number:020d}.json"


def entry(spark: SparkSession, folder: str, number: int) -> dict | None:
    text = read_text(spark, path_of(folder, number))
    return json.loads(text) if text else None


def last(spark: SparkSession, folder: str) -> dict:
    """The newest entry. Numbers are probed from a hint on, which may be behind; nothing is listed."""
    try:
        hint = read_text(spark, f"{folder}/commits/hint") or ""
    except Py4JJavaError:  # it is being written
        hint = ""
    found = entry(spark, folder, int(hint)) if hint.isdigit() else None
    found = found or START
    while (after := entry(spark, folder, found["number"] + 1)) is not None:
        found = after
    return found


def between(spark: SparkSession, folder: str, after: int, until: int) -> list[dict]:
    return [entry(spark, folder, n) for n in range(after + 1, until + 1)]


def add(spark: SparkSession, folder: str, new: dict) -> bool:
    """Whether the entry is the first of its number and now counts."""
    if not publish_text(spark, path_of(folder, new["number"]), json.dumps(new)):
        return False
    try:
        put_text(spark, f"{folder}/commits/hint", str(new["number"]))
    except Py4JJavaError:  # another load is writing it
        pass
    return True
