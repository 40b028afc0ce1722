"""A schema-free JSON record as a ``map<string,variant>`` column.

Unknown fields survive, nested objects keep their shape, numbers keep their text value through the
variant encoding (a 20-digit decimal is not turned into a double). JSON ``null`` is a variant null, not
a SQL NULL, so "has a value" is :func:`present`. All helpers return Columns and stay inside
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_OBJECT = "map<string,variant>"
JSON_OBJECT_ARRAY = "array<map<string,variant>>"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_object(text: Column | str) -> Column:
    """Text -> ``map<string,variant>``; NULL for bad text, empty text, NULL and non-object JSON."""
    return F.from_json(_c(text), JSON_OBJECT)


def repeats_key(m: Column) -> Column:
    """True when an object names a key twice (such text has no one meaning; it goes to the quarantine)."""
    keys = F.map_keys(m)
    return F.size(F.array_distinct(keys)) < F.size(keys)


def present(v: Column) -> Column:
    """True when the value exists and is not JSON null (false for an absent key)."""
    return v.isNotNull() & ~F.is_variant_null(v)


def as_object(v: Column) -> Column:
    """Variant -> ``map<string,variant>``; NULL when absent, JSON null, or not an object."""
    return v.try_cast(JSON_OBJECT)


def is_object(v: Column) -> Column:
    return as_object(v).isNotNull()


def as_object_array(v: Column) -> Column:
    """Variant array -> array of object maps; a non-object element becomes NULL, a non-array NULL."""
    return v.try_cast(JSON_OBJECT_ARRAY)


def get_string(v: Column, path: str = "$") -> Column:
    """Typed string access with coercion: numbers give their text, objects their JSON."""
    return F.try_variant_get(v, path, "string")


def get_long(v: Column, path: str = "$") -> Column:
    """Typed long access with coercion: ``17`` and ``"17"`` give 17; ``"abc"`` gives NULL."""
    return F.try_variant_get(v, path, "bigint")


def drop_keys(m: Column, keys: Iterable[str]) -> Column:
    """Remove the named keys from an object map (the JSON ``remove``)."""
    keys = list(keys)
    if not keys:
        return m
    return F.map_filter(m, lambda k, _v: ~k.isin(*keys))


def drop_null_values(m: Column) -> Column:
    """Leave out top-level keys whose value is JSON null, as the writer of the upstream jobs does."""
    return F.map_filter(m, lambda _k, v: ~F.is_variant_null(v))


# One JSON string; a member with a null value and the comma before it (a string that a colon follows is a
# key); a comma left at the start of an object.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NULL_MEMBER = rf'({_STRING}(?!:null[,}}]))|,?{_STRING}:null(?=[,}}])'
_FIRST_COMMA = rf'({_STRING})|(?<=\{{),'


def drop_null_members(json: Column) -> Column:
    """Compact JSON text without the null-valued members of its objects, at every depth; nulls in arrays stay.

    The text is read string by string, so what looks like a member inside a string is left alone. ``json`` is
    bound by a one-element array: it is often the writing of a whole record, which is to run once."""

    def bare(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, _NULL_MEMBER, "$1"), _FIRST_COMMA, "$1")

    return F.transform(F.array(json), lambda t: F.when(t.contains(":null"), bare(t)).otherwise(t))[0]


def put(m: Column, entries: dict[str, Column]) -> Column:
    """Set keys on an object map, overwriting; values are variants. ``map_concat`` refuses repeated
    keys under the default policy, so the keys are filtered out first."""
    if not entries:
        return m
    kv: list[Column] = []
    for k, v in entries.items():
        kv += [F.lit(k), v]
    return F.map_concat(drop_keys(m, entries.keys()), F.create_map(*kv))


def to_variant_object(m: Column) -> Column:
    """A rebuilt object map back to one variant value, so it can be nested in another map."""
    return F.to_variant_object(m)


def to_json_text(m: Column) -> Column:
    """Object map -> JSON text, null-valued keys left out at every depth. Key order is free; compare parsed."""
    return drop_null_members(F.to_json(drop_null_values(m)))
