"""Access to map, array and record columns.

Array positions count from 1 here. In Spark SQL text `arr[1]` counts from 0; write
`try_element_at(arr, 1)` there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def map_value(column: Column | str, key) -> Column:
    """The value under `key`; null if the key or the map is missing."""
    return _column(column).getItem(key)


def nth(column: Column | str, position: int) -> Column:
    """The element at `position`, counted from 1; null past the end."""
    if position < 1:
        raise ValueError("array positions count from 1")
    return F.get(_column(column), F.lit(position - 1))


def field(column: Column | str, *names: str) -> Column:
    """A field of a record, or of a record in it, by name."""
    out = _column(column)
    for name in names:
        out = out.getField(name)
    return out


def map_field(column: Column | str, key, *names: str) -> Column:
    """A field of the record a map holds under `key`."""
    return field(map_value(column, key), *names)


def nth_field(column: Column | str, position: int, *names: str) -> Column:
    """A field of the record at `position` of an array, counted from 1."""
    return field(nth(column, position), *names)
