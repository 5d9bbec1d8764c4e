"""Secret scan: three fixed kinds of spans, and spans of high local entropy.

A candidate is a run of key characters with both letters and digits. A window slides over it and
keeps the count of each character, packed into a few numbers; a step adds one character and takes one
away, which changes the sum of ``c * log2(c)`` by the terms of those two only. The candidate is
reported if the entropy of some window reaches the bound of its character class, unless it meets a
span found before. Windows that touch a pattern of the allow-list do not count; the others do.

The bounds are what 99 of 100 random strings of one window reach in the class's alphabet.

Places are code points, the end exclusive. Null texts are empty and have no spans; every row is
scanned by itself, repeated rows too. All of it are column expressions; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base kinds, with the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the first AKIA of a run takes all the rest, so short runs just drop out
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Bits of entropy in a window, for the first class that holds all characters of a candidate: the
# hundredth part of 20,000 random strings has less, in alphabets of 16, 36, 62 and 66 characters.
CLASSES = (("^[0-9a-f]+$|^[0-9A-F]+$", 2.90), ("^[0-9a-z]+$|^[0-9A-Z]+$", 3.40), ("^[A-Za-z0-9]+$", 3.64), ("^[A-Za-z0-9+/_=-]+$", 3.68))
ALLOWED = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i)example|placeholder|changeme|x{4,}",
    r"(?i)abcdefghij|0123456789|1234567890",
)
_PER_NUMBER, _BITS, _FIRST, _NUMBERS = 12, 5, 33, 8  # counts below 32 of the 94 visible ASCII characters
_TOGETHER = 64
_SPANS = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _places(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches, from their lengths and those of the text between them.

    Lengths are added up in groups of ``_TOGETHER`` matches and over the groups, so that a text with
    very many matches costs little more for each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    steps = F.transform(pairs, lambda p: F.struct(F.char_length(p["gap"]).cast("bigint").alias("gap"), F.char_length(p["hit"]).cast("bigint").alias("hit")))
    numbers = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _TOGETHER).cast("int"))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + pair["gap"]
        span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), (first + pair["hit"]).alias("stop"))
        return F.struct((first + pair["hit"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def total(group: Column) -> Column:
        return F.aggregate(group, F.lit(0).cast("bigint"), lambda n, p: n + p["gap"] + p["hit"])

    def spans(groups: Column) -> Column:
        sums = F.transform(groups, total)

        def of_group(group: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0).cast("bigint"), lambda n, x: n + x)
            start = F.struct(before.alias("at"), F.array().cast(_SPANS).alias("spans"))
            return F.aggregate(group, start, step, lambda state: state["spans"])

        return F.flatten(F.transform(groups, of_group))

    groups = F.transform(numbers, lambda i: F.slice(steps, i * _TOGETHER + 1, F.lit(_TOGETHER)))
    once = F.get(F.transform(F.array(groups), spans), 0)  # a name for the groups, so that they are made once
    return F.when(text.rlike(pattern), once).otherwise(F.array().cast(_SPANS))


def _long_values(text: Column, spans: Column) -> Column:
    """Assignments whose value has six characters or more."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    chosen = F.filter(F.arrays_zip(spans.alias("span"), values.alias("value")), lambda x: F.char_length(x["value"]) >= 6)
    return F.when(F.size(spans) > 0, F.transform(chosen, lambda x: x["span"])).otherwise(spans)


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of ``window`` visible ASCII characters in a row."""

    def term(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), _BITS * (code % _PER_NUMBER))

    def count(counts: Column, code: Column) -> Column:
        held = F.call_function("shiftright", F.get(counts, F.floor(code / _PER_NUMBER).cast("int")), _BITS * (code % _PER_NUMBER))
        return held.bitwiseAND(F.lit((1 << _BITS) - 1))

    def added(counts: Column, code: Column, sign: int) -> Column:
        at = F.floor(code / _PER_NUMBER).cast("int")
        return F.transform(counts, lambda v, i: F.when(i == at, v + sign * one(code)).otherwise(v))

    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), _NUMBERS).alias("counts"), F.lit(0.0).alias("sum"), F.lit(float(window * 100)).alias("least")
    )

    def step(state: Column, codes: Column) -> Column:
        new, old, counts = codes["new"], codes["old"], state["counts"]
        same = new == old
        had_new, had_old = count(counts, new), count(counts, old)
        gain = term(had_new + 1) - term(had_new)
        loss = F.when(old.isNull(), F.lit(0.0)).otherwise(term(had_old - 1) - term(had_old))
        total = state["sum"] + F.when(F.coalesce(same, F.lit(False)), F.lit(0.0)).otherwise(gain + loss)
        less = F.when(old.isNull(), counts).otherwise(added(counts, old, -1))
        least = F.when(codes["full"], F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(added(less, new, 1).alias("counts"), total.alias("sum"), least.alias("least"))

    def steps(codes: Column) -> Column:
        return F.transform(codes, lambda c, i: F.struct(c.alias("new"), F.get(codes, i - window).alias("old"), (i >= window - 1).alias("full")))

    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - _FIRST)
    moves = F.get(F.transform(F.array(codes), steps), 0)
    bits = F.aggregate(moves, start, step, lambda state: F.log2(F.lit(float(window))) - state["least"] / window)
    return F.when(F.char_length(text) >= window, F.round(bits, 6))


def _splitter(pattern: str):
    return lambda part: F.split(part, pattern, -1)


def _random_looking(word: Column, allowed: tuple[str, ...]) -> Column:
    """Whether a window of the word that touches nothing allowed reaches the bound of the word's class."""
    bound = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        bound = F.when(word.rlike(pattern), F.lit(bits)).otherwise(bound)
    rest = F.array(word)
    for pattern in allowed:
        rest = F.flatten(F.transform(rest, _splitter(pattern)))
    reached = F.exists(rest, lambda part: F.when(F.char_length(part) >= WINDOW, window_entropy(part) >= bound).otherwise(F.lit(False)))
    return F.when(word.rlike("[A-Za-z]") & word.rlike("[0-9]"), reached).otherwise(F.lit(False))


def _shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text``, ``base`` and ``added``, arrays of spans
    ``(start, kind, stop)`` in order, ``kind`` an index into ``KINDS``."""
    text = F.col("text")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = found.select("*", _places(text, ASSIGN, 0).alias("assign"), _places(text, ACCESS, 1).alias("access"), _places(text, HEX, 2).alias("hex"))
    words = F.arrays_zip(_places(text, CANDIDATE, 3).alias("span"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("word"))
    runs = F.when(text.rlike(CANDIDATE), words)
    found = found.select("doc_id", "text", _long_values(text, F.col("assign")).alias("assign"), "access", "hex", runs.alias("runs"))
    base = F.sort_array(F.concat("assign", "access", "hex"))
    found = found.select("doc_id", "text", base.alias("base"), "assign", "runs")

    def new(run: Column) -> Column:
        span, word = run["span"], run["word"]
        # The other base kinds are made of key characters, so they lie inside a run.
        other = word.rlike(HEX) | word.rlike(ACCESS)
        meets = F.exists(F.col("assign"), lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))
        return ~other & _random_looking(word, allowed) & ~meets

    kept = F.coalesce(F.transform(F.filter("runs", new), lambda run: run["span"]), F.array().cast(_SPANS))
    return found.select("doc_id", "text", "base", kept.alias("added"))


def secret_report(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Counts per kind, the sha256 of the base spans, and all spans as ``kind:start:end``."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return find_secrets(docs, allowed).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
        _shown(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )
