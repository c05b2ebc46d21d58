"""Checks on JSON texts that tell apart what plain extraction treats alike.

As usual among writers, bare NaN, Infinity and -Infinity are numbers, and of a name that comes
several times in an object the last value counts.  Strings are taken as they are.  Spark's reader also
takes -INF, +INF and +Infinity for numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = "\u0001end"
_OPTIONS = {"allowSingleQuotes": "false"}


def _entries(text: Column) -> Column:
    """(key, value as text) of an object at the start of the text, in order, repeated names included."""
    return F.map_entries(F.from_json(text, "map<string,string>", _OPTIONS))


def _enclosed(text: Column) -> Column:
    """The text as one of two members of an object; null entries unless it is exactly one JSON value.

    The reader stops after the first value; anything left over breaks the object around it.
    """
    entries = _entries(F.concat(F.lit('{"v":'), text, F.lit(',"\\u0001end":0}')))
    return F.when((F.size(entries) == 2) & (F.element_at(entries, -1)["key"] == _END), entries)


def normalised(text: Column) -> Column:
    """The text with NaN and infinities as strings; null unless it is exactly one JSON value."""
    return _enclosed(text)[0]["value"]


def members(text: Column) -> Column:
    """Entries (key, value as text) of the object; null unless the whole text is one JSON object."""
    return F.when(_enclosed(text).isNotNull(), _entries(text))


def is_json_object(text: Column) -> Column:
    """The whole text is one JSON object; names may repeat, numbers may be NaN or Infinity."""
    return members(text).isNotNull()


def member(entries: Column, name: str) -> Column:
    """The last value of a name as text: strings without quotes, NaN and infinities with them.

    Null if it is null or absent.
    """
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == name), F.lit(-1))["value"]


def typed_members(text: Column, schema: str) -> Column:
    """Members by type; null where absent or of another type. The last of repeated names counts."""
    return F.from_json(text, schema, _OPTIONS)


def last_of_repeated(counts: Column) -> Column:
    """The map without repeated keys: each with its last value."""
    keys = F.map_keys(counts)
    once = F.array_distinct(keys)
    entries = F.map_entries(counts)
    last = F.transform(once, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])
    return F.when(F.size(once) < F.size(keys), F.map_from_arrays(once, last)).otherwise(counts)
