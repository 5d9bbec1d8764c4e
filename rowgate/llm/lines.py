"""Site-relative line frequency: lines that very many pages of a host share are boilerplate.

The pages of a host are counted by their different texts, so copies of a page are one page. A line
is dropped where it stands on at least ``min_pages`` of them and on more than ``ratio`` of them.
Lines end at line feeds and count once a page, without the blanks around them; blank lines stay.

Null texts are empty and stay null; rows without a host form a host of their own; repeated rows are
all cleaned; an empty table gives no rows. Counting reduces in each task before every shuffle, so a
host with a third of all rows is no hot group. A host has at most (lines per page / ratio) dropped
lines; their table is broadcast only if its measured size is small, and joined on the host else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import free_name, stored

RATIO, MIN_PAGES = 0.08, 3
BROADCAST_BYTES = 8 * 1024 * 1024


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.md5(F.trim(line))


def boilerplate(docs: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host`` and ``dropped``, the keys of its boilerplate lines."""
    text = F.coalesce("text", F.lit(""))
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.md5(text).alias("page"), text.alias("text"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    filled = F.filter(_lines(F.col("text")), lambda line: F.trim(line) != "")
    keys = F.array_distinct(F.transform(filled, _key))
    seen = pages.select("host", "page", F.explode(keys).alias("line")).distinct()
    often = seen.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    common = often.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_set("line").alias("dropped"))


def _marked(docs: DataFrame, host: str, ratio: float, min_pages: int) -> tuple[DataFrame, Column, Column]:
    """``docs`` beside the keys to drop, its lines, and those that stay."""
    found = stored(boilerplate(docs, host, ratio, min_pages), "boilerplate")
    size = found.agg(F.sum(F.size("dropped") * 40 + F.octet_length("host") + 40)).first()[0] or 0
    key, dropped = free_name("host_key", docs.columns), free_name("dropped", docs.columns)
    found = found.select(F.col("host").alias(key), F.col("dropped").alias(dropped))
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    joined = docs.join(found, F.coalesce(docs[host].cast("string"), F.lit("")) == found[key], "left")
    lines = _lines(F.coalesce(docs["text"], F.lit("")))
    stays = F.filter(lines, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col(dropped), _key(line)))
    return joined, lines, F.when(F.col(dropped).isNull(), lines).otherwise(stays)


def cleaned(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs``, all columns, with boilerplate lines taken out of ``text`` and ``n_chars`` renewed."""
    joined, _, stays = _marked(docs, host, ratio, min_pages)
    text = F.when(docs["text"].isNotNull(), F.array_join(stays, "\n"))
    renewed = {"text": text}
    if "n_chars" in docs.columns:
        renewed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[renewed.get(c, docs[c]).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per document: ``n_lines``, ``n_dropped`` and the sha256 of the text that stays."""
    joined, lines, stays = _marked(docs, host, ratio, min_pages)
    report = joined.select(docs["doc_id"].cast("long").alias("doc_id"), F.size(lines).cast("long").alias("n_lines"), stays.alias("stays"))
    digest = F.sha2(F.array_join("stays", "\n"), 256)
    return report.select("doc_id", "n_lines", (F.col("n_lines") - F.size("stays")).alias("n_dropped"), digest.alias("kept_sha256"))
