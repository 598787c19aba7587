"""Messages decoded to a row or the reason why there is none, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topictables.functions import delimited as text
from topictables.functions.variant import MESSAGE, field_path, variant_value, variants
from topictables.operators.mapping import source_fields, table_columns
from topictables.plans.constraints import json_schema_violation
from topictables.plans.schema import json_schema, table_schema

#: The columns of a result besides those that are kept from the envelope.
ROW, REASON = "row", "reason"


def _results(rows: DataFrame, keep: Sequence[str], row: Column, reason: Column) -> DataFrame:
    """(kept columns, row, reason), where one of the two is null; computed once for all outputs."""
    tagged = F.struct(F.when(reason.isNull(), row).alias(ROW), reason.alias(REASON))
    once = rows.select(*keep, F.explode(F.array(tagged)).alias("_result"))
    return once.select(*keep, "_result.*")


def json_results(
    messages: DataFrame,
    schema: object = None,
    json_schema_text: str | dict | None = None,
    mapping: Mapping[str, str] | None = None,
    *,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one JSON object each, as `json_table` takes them, decoded to (row, reason).

    A message has a reason instead of a row if it has no bytes, is no JSON object, has a field whose
    value does not read as the declared type (a text that spells a number reads as one), or breaks a
    constraint of the JSON Schema text. The first such reason is given, with the field's name. The
    message is parsed once, into a variant.
    """
    if schema is None and json_schema_text is None:
        raise ValueError("results need a schema")
    declared = table_schema(schema) if schema is not None else None
    if json_schema_text is not None:
        fields = json_schema(json_schema_text)
    else:
        names = mapping or {}
        fields = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in declared])
    source_fields(declared, fields, mapping)
    known = [*keep, F.col("value").isNull().alias("_empty")]
    parsed = variants(messages.select(*known, "value"), "PERMISSIVE", [*keep, "_empty"])
    message = F.col(MESSAGE)
    record = F.struct(*[variant_value(message, f, "PERMISSIVE").alias(f.name) for f in fields])
    once = parsed.select(*keep, "_empty", MESSAGE, F.explode(F.array(record)).alias("_record"))
    reasons = [F.when(F.col("_empty"), F.lit("no bytes")), F.when(message.isNull(), F.lit("no JSON object"))]
    for f in fields:
        there = F.variant_get(message, field_path(f.name), "variant")
        wrong = there.isNotNull() & ~F.is_variant_null(there) & F.col("_record").getField(f.name).isNull()
        reasons.append(F.when(wrong, F.lit(f"field {f.name}: not a {f.dataType.simpleString()}")))
    if json_schema_text is not None:
        reasons.append(json_schema_violation(json_schema_text, F.col("_record")))
    row = F.struct(*table_columns(declared, fields, mapping, F.col("_record")))
    return _results(once, keep, row, F.coalesce(*reasons))


def delimited_results(
    messages: DataFrame,
    schema: object,
    *,
    field_delimiter: str = text.FIELD_DELIMITER,
    entry_delimiter: str = text.ENTRY_DELIMITER,
    key_delimiter: str = text.KEY_DELIMITER,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages of one delimited line each, as `delimited_table` takes them, decoded to (row, reason).

    A message has a reason instead of a row if it has no bytes or a field that is invalid for its
    type; the first such column is named. The line is split once.
    """
    parts = text.split_dropping_trailing(text.message_text(F.col("value")), field_delimiter)
    split = messages.select(*keep, F.explode(F.array(parts)).alias("_fields"))
    values, reasons = [], [F.when(F.col("_fields").isNull(), F.lit("no bytes"))]
    for i, f in enumerate(table_schema(schema)):
        part = F.get("_fields", F.lit(i))
        value, valid = text.convert(part, f, entry_delimiter, key_delimiter)
        values.append(value.alias(f.name, metadata=f.metadata))
        reasons.append(F.when(~valid, F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), part)))
    return _results(split, keep, F.struct(*values), F.coalesce(*reasons))


def good_rows(results: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of the messages that could be decoded."""
    return results.filter(F.col(REASON).isNull()).select(*keep, f"{ROW}.*")


def rejected(results: DataFrame) -> DataFrame:
    """The kept columns and the reason of the messages that could not."""
    return results.filter(F.col(REASON).isNotNull()).drop(ROW)
