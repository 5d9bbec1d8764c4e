"""Delimited text as column expressions: well-formedness, cell splitting, blank handling.

One grammar drives both the check and the split. All quantifiers are possessive: cells never need
backtracking, and Java's regex engine runs possessive groups in a loop, so a line or a quoted cell
of any length is matched in constant stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters up to U+0020, which count as blank.
BLANKS = "".join(chr(code) for code in range(0x21))

# Letters that name a control character after an escape character.
_CONTROL_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def is_blank(cell: Column) -> Column:
    return cell.rlike(r"^[\x00-\x20]*+\z")


def trim_blanks(cell: Column) -> Column:
    """Strip blanks from both ends; cells that have none at either end are passed through."""
    at_edge = (cell < "!") | (F.substring(cell, -1, 1) < "!")
    return F.when(at_edge, F.btrim(cell, F.lit(BLANKS))).otherwise(cell)


@dataclass(frozen=True)
class Dialect:
    """Delimiter, quote and escape characters; only the first character of each is used.

    An empty quote switches quoting off. An escape of ``"`` (or equal to the quote) means "no escape
    character": inside quotes, a doubled quote stands for one.
    """

    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'

    def __post_init__(self) -> None:
        if not self.delimiter or not self.escape:
            raise ValueError("delimiter and escape need a character")
        for name in ("delimiter", "quote", "escape"):
            object.__setattr__(self, name, getattr(self, name)[:1])
        if self.escape in ('"', self.quote):
            object.__setattr__(self, "escape", "")
        if self.delimiter in (self.quote, self.escape):
            raise ValueError("the delimiter must differ from quote and escape")

    @property
    def _cell(self) -> str:
        delimiter, quote, escape = (_literal(c) for c in (self.delimiter, self.quote, self.escape))
        escaped_pair = f"{escape}." if escape else ""
        plain = f"[^{delimiter}{escape}]*+"
        if escape:
            plain += f"(?:{escaped_pair}{plain})*+"
        if not quote:
            return plain
        pair = f"(?:{escaped_pair}|{quote}{quote})" if escape else quote + quote
        body = f"[^{quote}{escape}]*+"
        after = rf"[\p{{javaWhitespace}}&&[^{delimiter}]]*+"
        return f"(?:{quote}{body}(?:{pair}{body})*+{quote}{after}|(?!{quote}){plain})"

    def _has_markup(self, line: Column) -> Column:
        """Whether the line holds a quote or escape character at all; most lines do not."""
        tests = [F.contains(line, F.lit(c)) for c in (self.quote, self.escape) if c]
        return tests[0] | tests[1] if len(tests) == 2 else tests[0] if tests else F.lit(False)

    def is_malformed(self, line: Column) -> Column:
        """Empty line, unclosed quote, text after a closing quote, or an escape character at the very end."""
        well_formed = f"(?s)^{self._cell}(?:{_literal(self.delimiter)}{self._cell})*+\\z"
        return (line == "") | (self._has_markup(line) & ~line.rlike(well_formed))

    def split(self, line: Column) -> Column:
        """The cells of a well-formed line, quotes and escapes resolved.

        Lines without markup take the plain split; only the others pay for the grammar.
        """
        plain = F.split(line, _split_pattern(self.delimiter), -1)
        if self.escape:
            return F.when(self._has_markup(line), self._split_escaped(line)).otherwise(plain)
        if self.quote:
            return F.when(self._has_markup(line), self._split_quoted(line)).otherwise(plain)
        return plain

    def _split_quoted(self, line: Column) -> Column:
        """Split by rewriting the line with line feeds for delimiters; a physical line has none.

        No lambda is involved, so the whole load stays in one generated stage.
        """
        delimiter, quote = _literal(self.delimiter), _literal(self.quote)
        body = f"[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+"
        after = rf"[\p{{javaWhitespace}}&&[^{delimiter}]]*+"
        cell = f"{delimiter}(?:({quote})({body}){quote}{after}|([^{delimiter}]*+))"
        # A plain cell becomes \n + text, a quoted one \n + quote + body; no plain cell begins with a quote.
        listed = F.regexp_replace(F.concat(F.lit(self.delimiter), line), F.lit(cell), F.lit("\n$1$2$3"))
        # From the mark of a quoted cell on, match by match up to its end, two quotes stand for one.
        doubled = f"(\n{quote}|\\G(?!^))([^\n{quote}]*+){quote}{quote}"
        single = F.regexp_replace(listed, F.lit(doubled), F.lit("$1$2\\" + self.quote))
        unmarked = F.replace(single, F.lit("\n" + self.quote), F.lit("\n"))
        return F.split(F.substring(unmarked, 2, 2**31 - 1), "\n", -1)

    def _split_escaped(self, line: Column) -> Column:
        pattern = f"(?s){_literal(self.delimiter)}({self._cell})"
        raw = F.regexp_extract_all(F.concat(F.lit(self.delimiter), line), F.lit(pattern), F.lit(1))
        return F.transform(raw, self._resolve)

    def _resolve(self, cell: Column) -> Column:
        text = F.when(F.contains(cell, F.lit(self.escape)), self._unescape(cell, quoted=False)).otherwise(cell)
        if not self.quote:
            return text
        quote = _literal(self.quote)
        inner = F.regexp_extract(cell, f"(?s)^{quote}(.*){quote}", 1)
        return F.when(cell.startswith(self.quote), self._unescape(inner, quoted=True)).otherwise(text)

    def _unescape(self, cell: Column, quoted: bool) -> Column:
        """Resolve escapes in one left-to-right pass over the pieces of the cell."""
        escape, quote = _literal(self.escape), _literal(self.quote)
        doubled = f"|{quote}{quote}" if quoted else ""
        pieces = F.regexp_extract_all(cell, F.lit(f"(?s)({escape}.{doubled}|[^{escape}{quote}]++|.)"), F.lit(1))
        meanings = {self.escape + c: c for c in (self.delimiter, self.quote, self.escape) if c}
        for letter, control in _CONTROL_ESCAPES.items():
            meanings.setdefault(self.escape + letter, control)
            meanings.setdefault(self.escape + control, control)
        if quoted:
            meanings[self.quote * 2] = self.quote

        def meaning(piece: Column) -> Column:
            resolved = piece
            for written, meant in meanings.items():
                resolved = F.when(piece == written, F.lit(meant)).otherwise(resolved)
            return resolved

        return F.array_join(F.transform(pieces, meaning), "")


def _literal(char: str) -> str:
    """A character as a regex escape that is valid inside and outside a character class."""
    return f"\\x{{{ord(char):x}}}" if char else ""


def _split_pattern(char: str) -> str:
    """A character as a regex in the form that Java splits on without its regex engine."""
    return "\\" + char if char.isascii() and char.isprintable() and not char.isalnum() else char
