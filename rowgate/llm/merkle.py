"""Document fingerprints: a Merkle tree over sections, paragraphs and word groups.

A paragraph is a line, a section is set apart by blank lines. The root is the sha256 over the
sections, theirs over the paragraphs. Equal roots mean equal texts up to the width of blank lines,
whose exact form the root therefore hashes too. The fingerprint is the root and the branches below
it: for each section its paragraphs, for each paragraph the start of its sha256 and a short hash of
each of its word groups (up to four words of a sentence).

Two fingerprints are compared from the root down, and only where they differ: equal roots are equal
texts; sections with the same branches are common; of the others the paragraphs are compared, and of
those that differ the word groups. Likeness is the number of common word groups over that of all,
those of branches that occur in one text counted for it alone; different roots are never fully
alike. ``edits`` names the paragraphs that differ. A branch that repeats within a text counts once.

Null texts are empty. An empty text has no word groups; it is like another empty text only. Every row
counts for itself, so rows that repeat a ``doc_id`` are ordered by the md5 of their texts; rows
without a ``doc_id`` come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGEST, HASH = 16, 8  # hexadecimal digits of a paragraph and of a word group
SECTION = r"\n[ \n]*\n"
GROUP = r"(?:[^ \n]*[^ \n.!?] +){0,3}[^ \n]+ *|\n| +"
ROWS_PER_BUCKET, EDGES = 4_000, 512


def sections(text: Column) -> Column:
    """Sections of a text, each an array of the sha256 of its paragraphs."""
    return F.transform(F.split(text, SECTION, -1), lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.sha2(p, 256)))


def root(text: Column) -> Column:
    """The root over the sections; where blank lines are wider than one line feed pair, their exact
    form is hashed into it."""
    nodes = F.transform(sections(text), lambda leaves: F.sha2(F.array_join(leaves, ""), 256))
    wide = F.when(text.rlike(r"\n[ \n]+\n"), F.sha2(F.array_join(F.regexp_extract_all(text, F.lit(SECTION), F.lit(0)), "|"), 256))
    return F.sha2(F.concat(F.array_join(nodes, ""), F.coalesce(wide, F.lit(""))), 256)


def fingerprint(text: Column) -> Column:
    """The root, a colon, and the branches: sections by semicolons, their paragraphs by commas."""

    def group(words: Column) -> Column:
        return F.lpad(F.hex(F.xxhash64(words).bitwiseAND(F.lit((1 << 4 * HASH) - 1))), HASH, "0")

    def paragraph(line: Column) -> Column:
        hashes = F.transform(F.regexp_extract_all(line, F.lit(GROUP), F.lit(0)), group)
        return F.concat(F.substring(F.sha2(line, 256), 1, DIGEST), F.array_join(hashes, ""))

    def section(lines: Column) -> Column:
        return F.array_join(F.transform(F.split(lines, "\n", -1), paragraph), ",")

    return F.concat(root(text), F.lit(":"), F.array_join(F.transform(F.split(text, SECTION, -1), section), ";"))


def _sections(printed: Column) -> Column:
    return F.split(F.substring(printed, F.lit(66), F.char_length(printed)), ";", -1)


def _paragraphs(sections: Column) -> Column:
    return F.flatten(F.transform(sections, lambda s: F.split(s, ",", -1)))


def _size(paragraphs: Column) -> Column:
    """The word groups of some paragraphs."""
    sizes = F.transform(paragraphs, lambda p: (F.char_length(p) - DIGEST) / HASH)
    return F.aggregate(sizes, F.lit(0.0), lambda n, size: n + size)


def _groups(paragraphs: Column) -> Column:
    return F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(F.substring(p, F.lit(DIGEST + 1), F.char_length(p)), F.lit(f".{{{HASH}}}"), F.lit(0))))


def _with_name(value: Column, use) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def likeness(one: Column, other: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""

    def of_groups(x: Column) -> Column:
        common = x["common"] + F.size(F.array_intersect(x["a"], x["b"]))
        total = common + F.size(F.array_except(x["a"], x["b"])) + F.size(F.array_except(x["b"], x["a"]))
        return F.when(total > 0, F.least(common / total, F.lit(0.999999999))).otherwise(F.lit(0.0))

    def of_paragraphs(x: Column) -> Column:
        common = x["common"] + _size(F.array_intersect(x["a"], x["b"]))
        a, b = _groups(F.array_except(x["a"], x["b"])), _groups(F.array_except(x["b"], x["a"]))
        return _with_name(F.struct(common.alias("common"), a.alias("a"), b.alias("b")), of_groups)

    def of_sections(x: Column) -> Column:
        common = _size(_paragraphs(F.array_intersect(x["a"], x["b"])))
        a, b = _paragraphs(F.array_except(x["a"], x["b"])), _paragraphs(F.array_except(x["b"], x["a"]))
        return _with_name(F.struct(common.alias("common"), a.alias("a"), b.alias("b")), of_paragraphs)

    unlike = _with_name(F.struct(_sections(one).alias("a"), _sections(other).alias("b")), of_sections)
    return F.when(F.substring(one, 1, 64) == F.substring(other, 1, 64), F.lit(1.0)).otherwise(F.round(unlike, 9))


def edits(one: Column, other: Column) -> Column:
    """Where the first text differs: ``(section, paragraph)``, from 0, of the paragraphs that the
    differing sections of the second do not have. Equal branches are not looked into."""
    place = "array<struct<section:int,paragraph:int>>"

    def differing(x: Column) -> Column:
        held = _paragraphs(F.array_except(x["b"], x["a"]))

        def of_section(section: Column, i: Column) -> Column:
            found = F.transform(F.split(section, ",", -1), lambda p, j: F.when(~F.array_contains(held, p), F.struct(i.alias("section"), j.alias("paragraph"))))
            return F.when(F.array_contains(x["b"], section), F.array().cast(place)).otherwise(F.filter(found, lambda f: f.isNotNull()).cast(place))

        return F.flatten(F.transform(x["a"], of_section))

    found = _with_name(F.struct(_sections(one).alias("a"), _sections(other).alias("b")), differing)
    return F.when(F.substring(one, 1, 64) == F.substring(other, 1, 64), F.array().cast(place)).otherwise(found)


def tree(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``root`` and ``sections``: per section its digest and the digests of its paragraphs."""
    text = F.coalesce("text", F.lit(""))
    nodes = F.transform(
        sections(text), lambda leaves: F.struct(F.sha2(F.array_join(leaves, ""), 256).alias("digest"), leaves.alias("paragraphs"))
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), root(text).alias("root"), nodes.alias("sections"))


def _with_bucket(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows with a ``key`` and a range ``bucket`` of it, about ``ROWS_PER_BUCKET`` rows each.

    Up to ``EDGES`` quantiles of the ids are gathered; ranges between them are cut evenly."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    keyed = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = keyed.where("doc_id is not null")
    shares = [i / EDGES for i in range(EDGES)]
    found = known.agg(F.count("*").alias("n"), F.percentile_approx("key", shares, 10_000).alias("edges"), F.max("key").alias("top")).first()
    buckets = max(1, (found.n or 0) // ROWS_PER_BUCKET)
    coarse = min(EDGES, buckets)
    edges = sorted({found.edges[i * EDGES // coarse] for i in range(coarse)}) if found.edges else []
    if not edges:
        return keyed.withColumn("bucket", F.lit(0).cast("long")), 1
    fine = -(-buckets // len(edges))
    lows = F.array(*[F.lit(e).cast("long") for e in edges])
    highs = F.array(*[F.lit(e).cast("long") for e in [*edges[1:], found.top + 1]])
    part = F.greatest(F.size(F.filter(lows, lambda e: e <= F.col("key"))) - 1, F.lit(0))
    low, high = F.get(lows, part).cast("double"), F.get(highs, part).cast("double")
    inside = F.least(F.greatest(F.floor((F.col("key").cast("double") - low) / (high - low) * fine), F.lit(0)), F.lit(fine - 1))
    return keyed.withColumn("bucket", (part * fine + inside).cast("long")), len(edges) * fine


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``fingerprint``, and those of the next row in descending ``doc_id``
    order as ``next_text`` and ``next_fingerprint``; the first row follows the last.

    Rows are dealt by ranges of ids, the ranges sized by their rows, so no task sees them all. The
    top rows of a range are sent once more to the range above it, where they end it; the table of
    tops has one row a range."""
    placed, _ = _with_bucket(docs)
    tops = placed.groupBy("bucket").agg(F.max("key").alias("top"))
    everything = Window.orderBy("bucket")  # a row per range
    above = F.coalesce(F.lead("bucket").over(everything), F.min("bucket").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    tops = F.broadcast(tops.select("top", above.alias("above")))
    copied = placed.join(tops, placed.key == tops.top, "left")
    turns = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("turn")))
    again = F.array(F.struct(F.col("above").alias("bucket"), F.lit(1).alias("turn")))
    dealt = copied.select("key", "doc_id", "text", F.explode(F.when(F.col("above").isNotNull(), F.concat(turns, again)).otherwise(turns)).alias("x"))
    dealt = dealt.select("key", "doc_id", "text", "x.bucket", "x.turn").repartition("bucket")
    printed = dealt.select("*", F.md5("text").alias("tie"), fingerprint(F.col("text")).alias("fingerprint"))
    order = Window.partitionBy("bucket").orderBy("turn", F.desc("key"), "tie")
    both = printed.select("*", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint"))
    return both.where("turn = 0").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")


def edit_report(docs: DataFrame) -> DataFrame:
    """Each document against itself with its last third replaced by the start of the next one, and
    against that next one."""
    pairs = with_next(docs)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    made = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    made = made.select("*", fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
