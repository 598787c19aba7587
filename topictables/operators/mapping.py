"""Table columns over format fields: rename and narrow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import types as T


def source_fields(
    declared: T.StructType | None,
    fields: T.StructType,
    mapping: Mapping[str, str] | None = None,
) -> list[str]:
    """The format field behind each declared column, checked to exist with the declared type."""
    mapping = mapping or {}
    if declared is None:
        unknown = set(mapping.values()) - set(fields.names)
        if unknown:
            raise ValueError(f"the format has no field {', '.join(sorted(unknown))}")
        return fields.names
    stray = set(mapping) - set(declared.names)
    if stray:
        raise ValueError(f"the mapping names no column of the table: {', '.join(sorted(stray))}")
    sources = []
    for column in declared.fields:
        source = mapping.get(column.name, column.name)
        if source not in fields.names:
            raise ValueError(f"column {column.name}: the format has no field {source}")
        have, want = (k.simpleString() for k in (fields[source].dataType, column.dataType))
        if have != want:
            raise ValueError(f"column {column.name} is {want}, field {source} is {have}")
        sources.append(source)
    return sources


def table_columns(
    declared: T.StructType | None,
    fields: T.StructType,
    mapping: Mapping[str, str] | None,
    record: Column,
) -> list[Column]:
    """The table's columns over a decoded record.

    Without a declared schema the table has all fields of the format, renamed by the mapping.
    """
    sources = source_fields(declared, fields, mapping)
    if declared is not None:
        names = declared.names
    else:
        names_of = {source: name for name, source in (mapping or {}).items()}
        names = [names_of.get(source, source) for source in sources]
    return [
        record.getField(source).alias(name) for name, source in zip(names, sources, strict=True)
    ]


def narrowed(
    declared: T.StructType | None,
    fields: T.StructType,
    mapping: Mapping[str, str] | None,
    columns: Sequence[str] | None,
) -> tuple[T.StructType | None, Mapping[str, str] | None]:
    """The declared columns and the mapping for some of the table's columns; all if none are named."""
    if columns is None:
        return declared, mapping
    sources = source_fields(declared, fields, mapping)
    if declared is None:
        names_of = {source: name for name, source in (mapping or {}).items()}
        declared = T.StructType([T.StructField(names_of.get(s, s), fields[s].dataType) for s in sources])
    unknown = set(columns) - set(declared.names)
    if unknown:
        raise ValueError(f"the table has no column {', '.join(sorted(unknown))}")
    source_of = dict(zip(declared.names, sources, strict=True))
    return T.StructType([declared[c] for c in columns]), {c: source_of[c] for c in columns}
