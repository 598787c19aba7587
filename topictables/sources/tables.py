"""Tables over the messages of a topic: Avro, JSON and delimited text.

Each function turns a DataFrame of envelopes, batch or streaming, into a DataFrame of typed
columns. `schema` declares the table's columns; `mapping` names the format field behind a column
where the two differ; `keep` passes envelope columns through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topictables.functions import delimited as text
from topictables.functions.avro import from_avro_message
from topictables.functions.json_text import from_json_message
from topictables.functions.variant import MESSAGE, variant_value, variants
from topictables.operators.mapping import narrowed, source_fields, table_columns
from topictables.plans.constraints import json_schema_violation
from topictables.plans.evolution import evolved, unified
from topictables.plans.schema import avro_schema, json_schema, table_schema


def _value(mode: str) -> Column:
    """The message bytes; a message without bytes is an error unless broken messages are let by."""
    if mode == "FAILFAST":
        return F.coalesce(F.col("value"), F.raise_error(F.lit("null message")).cast("binary"))
    return F.col("value")


def avro_table(
    messages: DataFrame,
    record: str | dict,
    schema: object = None,
    mapping: Mapping[str, str] | None = None,
    *,
    columns: Sequence[str] | None = None,
    mode: str = "FAILFAST",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one Avro record each.

    Without `schema` the table has the record's fields, or those named in `columns`. Only fields
    behind the table's columns are built from the bytes, so name those that a query uses.
    """
    declared = table_schema(schema) if schema is not None else None
    fields = avro_schema(record)
    if columns is not None:
        if declared is not None:
            raise ValueError("give either a schema or the columns of the record")
        unknown = set(columns) - set(fields.names)
        if unknown:
            raise ValueError(f"the record has no field {', '.join(sorted(unknown))}")
        declared = T.StructType([fields[name] for name in columns])
    wanted = source_fields(declared, fields, mapping)
    decoded = from_avro_message(_value(mode), record, wanted, mode)
    # Exploding one array keeps filters on decoded columns above the decoder, which would otherwise
    # run twice; filters on envelope columns still pass below it.
    rows = messages.select(*keep, F.explode(F.array(decoded)).alias("_record"))
    return rows.select(*keep, *table_columns(declared, fields, mapping, F.col("_record")))


def json_table(
    messages: DataFrame,
    schema: object = None,
    json_schema_text: str | dict | None = None,
    mapping: Mapping[str, str] | None = None,
    *,
    columns: Sequence[str] | None = None,
    as_variant: bool = False,
    check: bool = False,
    mode: str = "FAILFAST",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one JSON object each; the format is a table schema (S4) or JSON Schema.

    A message is parsed once, whatever the number of conditions and columns of a query. Only fields
    behind the table's columns are built, or those behind `columns` of them, so name those that a
    query uses. With `as_variant` the message is parsed into a variant, out of which each used column
    is taken by its path; without any schema the table is that variant, in the column `message`.
    With `check` every message must also keep to the constraints of the JSON Schema text; FAILFAST
    raises on one that does not, PERMISSIVE makes its row null.
    """
    if schema is None and json_schema_text is None:
        if not as_variant:
            raise ValueError("a JSON table needs a schema")
        return variants(messages, mode, keep)
    declared = table_schema(schema) if schema is not None else None
    fields = json_schema(json_schema_text) if json_schema_text is not None else None
    if fields is None:
        names = mapping or {}
        fields = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in declared])
    violation = json_schema_text if check else None
    if check and json_schema_text is None:
        raise ValueError("only a JSON Schema text has constraints to check")
    declared, mapping = narrowed(declared, fields, mapping, columns)
    used = source_fields(declared, fields, mapping) if violation is None else fields.names
    if as_variant:
        parsed = variants(messages, mode, keep)
        record = F.struct(*[variant_value(F.col(MESSAGE), f, mode).alias(f.name) for f in fields if f.name in used])
        if violation is None:  # every column is taken out of the variant by itself
            return parsed.select(*keep, *table_columns(declared, fields, mapping, record))
        rows = parsed.select(*keep, F.explode(F.array(record)).alias("_record"))
    else:
        decoded = from_json_message(_value(mode), T.StructType([f for f in fields if f.name in used]), mode)
        # Exploding one array keeps filters on decoded columns above the parser, which would otherwise
        # run once for each of them; filters on envelope columns still pass below it.
        rows = messages.select(*keep, F.explode(F.array(decoded)).alias("_record"))
    if violation is not None:
        broken = json_schema_violation(violation, F.col("_record"))
        whole = F.when(broken.isNull(), F.col("_record"))
        if mode == "FAILFAST":
            whole = F.coalesce(whole, F.raise_error(broken).cast(rows.schema["_record"].dataType))
        rows = rows.select(*keep, F.explode(F.array(whole)).alias("_record"))
    return rows.select(*keep, *table_columns(declared, fields, mapping, F.col("_record")))


Version = tuple[Column, object, Mapping[str, str] | None]


def json_versions_table(
    messages: DataFrame,
    versions: Sequence[Version],
    defaults: Mapping[str, object] | None = None,
    *,
    mode: str = "FAILFAST",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one JSON object each, written under several versions of a schema (K6).

    A version is a condition on the envelope, its schema, and the names that renamed fields have in the
    versions before. The table has the schema that all versions can be cast to; fields that a version
    lacks are null, or the entry of `defaults` for their path. A message is parsed once, by the first
    version whose condition it meets; one that meets none is refused, or null if the mode is PERMISSIVE.
    """
    schemas = [table_schema(schema) for _, schema, _ in versions]
    whole = schemas[0]
    for schema, (_, _, aliases) in zip(schemas[1:], versions[1:], strict=True):
        whole = unified(whole, schema, aliases)
    record = None
    for schema, (condition, _, aliases) in zip(schemas, versions, strict=True):
        parsed = from_json_message(F.when(condition, _value(mode)), schema, "PERMISSIVE" if mode == "PERMISSIVE" else "FAILFAST")
        row = F.get(F.transform(F.array(parsed), lambda r: evolved(r, schema, whole, aliases, defaults)), F.lit(0))  # noqa: B023
        record = F.when(condition, row) if record is None else record.when(condition, row)
    if mode == "FAILFAST":
        record = record.otherwise(F.raise_error(F.lit("a message of no known version")).cast(whole))
    rows = messages.select(*keep, F.explode(F.array(record)).alias("_record"))
    return rows.select(*keep, "_record.*")


def delimited_table(
    messages: DataFrame,
    schema: object,
    *,
    field_delimiter: str = text.FIELD_DELIMITER,
    entry_delimiter: str = text.ENTRY_DELIMITER,
    key_delimiter: str = text.KEY_DELIMITER,
    mode: str = "FAILFAST",
    check_all: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one delimited line each, fields taken by position."""
    line = text.message_text(_value(mode))
    fields = text.split_dropping_trailing(line, field_delimiter)
    # Exploding one array keeps filters on decoded columns above the split, which would otherwise
    # be repeated for every use of a field; filters on envelope columns still pass below it.
    rows = messages.select(*keep, F.explode(F.array(fields)).alias("_fields"))
    columns = text.delimited_columns(
        F.col("_fields"),
        table_schema(schema),
        mode=mode,
        check_all=check_all,
        entry_delimiter=entry_delimiter,
        key_delimiter=key_delimiter,
    )
    return rows.select(*keep, *columns)
