"""Column specifications: ``name|type|tag|tag,name|type`` <-> ``StructType``.

Tags and the place in the primary key travel in ``StructField.metadata`` so that a stored table
can hand its full specification back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_COLUMN = "_load"  # per-row load facts, see operators.load

# Type words of the specification language.
_TYPE_WORDS = {
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
}
_KEY_TAG = re.compile(r"\$?primary_key(?:\((?P<place>-?\d+)\))?.*", re.DOTALL)


def ref(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class TableSpec:
    """Typed columns plus the ordered primary key."""

    schema: T.StructType

    @property
    def names(self) -> list[str]:
        return self.schema.names

    @property
    def keys(self) -> list[str]:
        placed = [(f.metadata["key"], i, f.name) for i, f in enumerate(self.schema) if "key" in f.metadata]
        return [name for _, _, name in sorted(placed)]

    def header_cells(self) -> list[str]:
        """One self-describing cell per column: ``name|type|tag...``."""
        in_column_order = self.keys == [f.name for f in self.schema if "key" in f.metadata]
        cells = []
        for field in self.schema:
            parts = [field.name, _type_word(field.dataType)]
            if "key" in field.metadata:
                place = "" if in_column_order else f"({self.keys.index(field.name)})"
                parts.append("primary_key" + place)
            cells.append("|".join(parts + tags_of(field)))
        return cells


def tags_of(field: T.StructField) -> list[str]:
    default = ["timestamp"] if isinstance(field.dataType, T.TimestampType) else []
    return list(field.metadata.get("tags", default))


def is_nullable(field: T.StructField) -> bool:
    """Declared columns are nullable only by tag; other tables have Spark's own flag."""
    return "nullable" in tags_of(field) if "tags" in field.metadata else field.nullable


def _type_word(data_type: T.DataType) -> str:
    """The word of a type; what the language cannot say is exported as text."""
    if isinstance(data_type, T.TimestampType):
        return "long"
    words = {known: word for word, known in _TYPE_WORDS.items()}
    return words.get(data_type, "string")


def _type_of(word: str, tags: list[str], name: str) -> T.DataType:
    try:
        data_type = _TYPE_WORDS[word.lower()]
    except KeyError:
        raise ValueError(f'Invalid data type "{word}" for column {name}') from None
    if "timestamp" not in tags:
        return data_type
    if not isinstance(data_type, T.LongType):
        raise ValueError(f"column {name}: only a long can carry the timestamp tag")
    return T.TimestampType()


def parse_spec(text: str) -> TableSpec:
    """Read a specification. Names are kept as written; tags are trimmed and lower-cased.

    ``$primary_key(n)`` gives the place in the key, ``$primary_key`` (or ``primary_key``) takes the
    place after the largest one so far. A column without a type is a string.
    """
    fields = []
    last_place = -1
    for entry in text.rstrip(",").split(","):
        name, *rest = entry.split("|")
        if not name:
            raise ValueError(f"empty column name in specification {text!r}")
        if name.lower() in [LOAD_COLUMN] + [f.name.lower() for f in fields]:
            raise ValueError(f"column name {name!r} is reserved or repeated")
        tags: list[str] = []
        metadata: dict = {}
        for tag in (t.strip().lower() for t in rest[1:]):
            key = _KEY_TAG.fullmatch(tag)
            if key is None:
                tags.append(tag)
                continue
            place = int(key["place"]) if key["place"] not in (None, "-1") else last_place + 1
            last_place = max(last_place, place)
            metadata["key"] = place
        metadata["tags"] = tags
        data_type = _type_of(rest[0] if rest else "string", tags, name)
        fields.append(T.StructField(name, data_type, True, metadata))
    return TableSpec(T.StructType(fields))
