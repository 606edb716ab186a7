"""Reading JSON objects whose fields may be absent, null or of any type.

The fields of interest are read into a struct of variants. A variant tells what a typed
column would lose: SQL NULL is an absent key, a VOID variant a JSON null, and a number
differs from the same digits sent as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
# Read behind the text: it is only found when the text is one whole object.
_END = "__end__"


def parse_object(text: Column, names: list[str], plain: list[str]) -> Column:
    """JSON object text to a struct with the given fields; null for anything else.

    ``plain`` fields are text, the others variants. Of a repeated key the last value
    counts.
    """
    types = ", ".join(f"`{n}`: {'string' if n in plain else 'variant'}" for n in [*names, _END])
    wrapped = F.concat(F.lit("["), text, F.lit(f', {{"{_END}": 1}}]'))
    items = F.from_json(wrapped, f"array<struct<{types}>>", _JSON)
    whole = (F.size(items) == 2) & F.try_element_at(items, F.lit(2))[_END].isNotNull()
    return F.when(F.is_valid_utf8(text) & whole, F.try_element_at(items, F.lit(1)))


def key_order(text: Column) -> Column:
    """The keys of an object in the order of their first mention."""
    return F.array_distinct(F.map_keys(F.from_json(text, "map<string,variant>", _JSON)))


def all_fields(text: Column) -> Column:
    """Every key and value of an object."""
    return F.from_json(text, "map<string,variant>", _JSON)


def unlisted_map(text: Column, names: list[str]) -> Column:
    """The fields of an object whose names are not in ``names``."""
    return F.map_filter(all_fields(text), lambda k, v: ~k.isin(names))


def map_variant(rest: Column) -> Column:
    """A map of fields as one variant; null if there are none. Read a field with
    ``try_variant_get(extras, '$.name', 'type')``."""
    return F.when(F.size(rest) > 0, F.to_variant_object(rest))


def type_name(value: Column) -> Column:
    """NULL for an absent key, VOID for a JSON null, else BOOLEAN, BIGINT, STRING, ..."""
    return F.schema_of_variant(value)


def is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def is_nested(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")
