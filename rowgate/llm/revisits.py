"""Resolution of not-modified WARC revisit records.

A revisit says that a URL still had what an earlier capture holds. It is joined, as of its time, to
the latest full response captured strictly earlier under the same canonical URL. The validators
must agree (ETag, compared weakly; else Last-Modified; else payload digest), and the headers that a
304 answer may renew replace those of the response.

``records`` has ``record_id``, ``kind`` (``response`` or ``revisit``), ``url``, ``captured`` (long),
``digest`` and ``headers`` (a map). Header names compare in lower case; of two spellings of one name
the last counts; null headers are none. Of responses at the same time the largest ``record_id`` is
the latest. A revisit without URL or time has no original; records of other kinds are ignored;
repeated revisits get a row each; an empty table gives no rows.

A URL may hold a third of all records: time is cut into ``SLICES`` ranges, records are ordered
within a URL and range only, and a range takes over the last response of the ranges before it,
found from one row per URL and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 4_096
# Header fields of a stored response that a 304 answer renews (RFC 9110, 15.4.5).
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
OUTCOMES = ("resolved", "validator_mismatch", "no_validator", "no_original")


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.``, default port, fragment, and slash at the end; host in lower case."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(rest, "^[^/?]*", ""), "/+$", "")
    return F.concat(host, path)


def _fields(headers: Column) -> Column:
    """Header fields as ``(name, value)`` with lower-case names, one each, in order of name."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    pairs = F.coalesce(pairs, F.array().cast("array<struct<name:string,value:string>>"))
    later = lambda pair, i: F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda other: other["name"] == pair["name"])
    return F.sort_array(F.filter(pairs, lambda pair, i: ~later(pair, i)))


def _value(fields: Column, name: str) -> Column:
    return F.get(F.transform(F.filter(fields, lambda f: f["name"] == name), lambda f: f["value"]), F.lit(0))


def _etag(fields: Column) -> Column:
    return F.regexp_replace(_value(fields, "etag"), "^W/", "")


def merged_headers(stored: Column, answer: Column) -> Column:
    """The stored fields, with those that a 304 may renew taken from the answer."""
    new = F.filter(answer, lambda f: f["name"].isin(*RENEWED))
    kept = F.filter(stored, lambda f: ~F.exists(new, lambda n: n["name"] == f["name"]))
    return F.sort_array(F.concat(kept, new))


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Per revisit: ``record_id``, ``url`` (canonical), ``refers_to``, ``outcome`` and ``headers``
    (fields of the resolved record; its own where there is none)."""
    known = records.where(F.col("kind").isin("response", "revisit"))
    known = known.select(
        F.col("record_id").cast("long").alias("record_id"),
        (F.col("kind") == "response").alias("full"),
        canonical_url(F.col("url")).alias("url"),
        F.col("captured").cast("long").alias("captured"),
        "digest",
        _fields(F.col("headers")).alias("fields"),
    )
    span = known.agg(F.min("captured").alias("first"), F.max("captured").alias("last")).first()
    first, width = span.first or 0, max(1, ((span.last or 0) - (span.first or 0)) // slices + 1)
    placed = known.withColumn("slice", F.floor((F.col("captured") - first) / width).cast("long"))
    usable = placed.where("url is not null and captured is not null")
    response = F.when(F.col("full"), F.struct("captured", "record_id", "digest", "fields"))
    moment = F.struct("captured", "record_id")
    last_in = usable.where("full").groupBy("url", "slice").agg(F.max_by(F.struct("captured", "record_id", "digest", "fields"), moment).alias("last"))
    slots = usable.select("url", "slice").distinct().join(last_in, ["url", "slice"], "left")
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("url", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))
    # Within a moment revisits come first, so that "earlier" is strict.
    here = Window.partitionBy("url", "slice").orderBy("captured", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = usable.withColumn("near", F.last(response, ignorenulls=True).over(here)).where("not full")
    found = near.join(carried, ["url", "slice"], "left").withColumn("original", F.coalesce("near", "carried"))
    lost = placed.where("not full and (url is null or captured is null)").withColumn("original", F.lit(None).cast(found.schema["original"].dataType))
    columns = ["record_id", "url", "digest", "fields", "original"]
    both = found.select(*columns).unionByName(lost.select(*columns))
    ours, theirs = F.col("fields"), F.col("original.fields")
    checks = F.coalesce(
        _etag(ours) == _etag(theirs),
        _value(ours, "last-modified") == _value(theirs, "last-modified"),
        F.col("digest") == F.col("original.digest"),
    )
    outcome = (
        F.when(F.col("original").isNull(), "no_original").when(checks.isNull(), "no_validator")
        .when(checks, "resolved").otherwise("validator_mismatch")
    )
    judged = both.select("record_id", "url", outcome.alias("outcome"), "original", "fields")
    good = F.col("outcome") == "resolved"
    return judged.select(
        "record_id",
        "url",
        F.when(good, F.col("original.record_id")).alias("refers_to"),
        "outcome",
        F.when(good, merged_headers(theirs, ours)).otherwise(ours).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Captures derived from ``pages``: a full response for each page, one a minute in the order of
    ``page_id``, and a revisit of the page's URL some time later (for a seventh of them: before),
    with the page's validators and headers that may and may not be renewed."""
    html = F.coalesce("html", F.lit(""))
    at = F.col("page_id").cast("long") * 60
    tag = F.concat(F.lit('"'), F.md5(html), F.lit('"'))
    size = F.length(html)
    response = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), size.cast("string"),
        F.lit("ETag"), tag, F.lit("Date"), at.cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    later = at + (size % 7 * 100 - 50)
    revisit = F.create_map(
        F.lit("Content-Length"), F.lit("0"), F.lit("etag"), F.concat(F.lit("W/"), tag),
        F.lit("Date"), later.cast("string"), F.lit("Set-Cookie"), F.lit("a=b"), F.lit("Expires"), (later + 60).cast("string"),
    )
    number = F.col("page_id").cast("long") * 2
    columns = lambda number, kind, at, headers: F.struct(
        number.alias("record_id"), F.lit(kind).alias("kind"), at.alias("captured"), headers.alias("headers")
    )
    both = F.array(columns(number, "response", at, response), columns(number + 1, "revisit", later, revisit))
    return pages.select("url", F.md5(html).alias("digest"), F.explode(both).alias("r")).select("r.*", "url", "digest")


def revisit_report(pages: DataFrame) -> DataFrame:
    """The revisits of ``records_of_pages`` with the headers as lines of text."""
    lines = F.array_join(F.transform("headers", lambda f: F.concat_ws(": ", f["name"], f["value"])), "\n")
    return resolve_revisits(records_of_pages(pages)).select("record_id", "url", "refers_to", "outcome", lines.alias("headers"))
