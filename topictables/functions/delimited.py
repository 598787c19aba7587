"""Delimited-text messages as column expressions.

Every declared column becomes one Spark expression over the split message, so Catalyst prunes
columns nobody reads and nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_DELIMITER = "\t"
ENTRY_DELIMITER = ","
KEY_DELIMITER = ":"

MODES = ("FAILFAST", "PERMISSIVE")

# Accepted spellings of the typed fields.
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
DATE_TEXT = r"^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])\z"
TIME_TEXT = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]Z\z"
TIMESTAMP_TEXT = (
    r"^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])[T ]"
    r"([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9](\.[0-9]{1,9})?Z\z"
)

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def message_text(value: Column) -> Column:
    """Message bytes as UTF-8 text; invalid bytes become U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))


def split_pattern(delimiter: str) -> str:
    """A regex that matches `delimiter` literally.

    One plain character stays as it is: the JVM splits on it without compiling a pattern per row.
    """
    if not delimiter:
        raise ValueError("a delimiter must have at least one character")
    if len(delimiter) == 1 and not delimiter.isalnum() and ord(delimiter) < 128:
        return "\\" + delimiter if delimiter in ".$|()[{^?*+\\" else delimiter
    if delimiter.isalnum():
        return delimiter
    return "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def strip_trailing(text: Column, delimiter: str) -> Column:
    """Drop the run of delimiters at the end of `text`."""
    if len(delimiter) == 1:
        return F.rtrim(text, F.lit(delimiter))
    return F.regexp_replace(text, f"(?:{split_pattern(delimiter)})+\\z", "")


def split_dropping_trailing(text: Column, delimiter: str) -> Column:
    """Split `text`, without empty parts at the end.

    Text of delimiters only has no part at all; empty text has one empty part.
    """
    if any(delimiter.startswith(delimiter[i:]) for i in range(1, len(delimiter))):
        # Occurrences of such a delimiter can overlap: only a split from the left finds the right ones.
        return _let(F.split(text, split_pattern(delimiter)), lambda parts: _without_trailing(parts, text))
    stripped = strip_trailing(text, delimiter)
    return F.when(
        (stripped == "") & (text != ""), F.array().cast("array<string>")
    ).otherwise(F.split(stripped, split_pattern(delimiter)))


def _without_trailing(parts: Column, text: Column) -> Column:
    filled = F.array_max(F.transform(parts, lambda part, i: F.when(part != "", i + 1)))
    last = F.when(text == "", F.lit(1)).otherwise(F.coalesce(filled, F.lit(0)))
    return F.slice(parts, F.lit(1), last)


def _let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def string_map(
    field: Column,
    entry_delimiter: str = ENTRY_DELIMITER,
    key_delimiter: str = KEY_DELIMITER,
) -> Column:
    """Text `k:v,k:v` as map<string,string>; the last entry of a repeated key wins.

    An entry without a value gets "", parts after the second are dropped. Entries for which
    `bad_map_entry` holds have no key; check that first.
    """
    if len(entry_delimiter) == len(key_delimiter) == 1 and entry_delimiter != key_delimiter:
        return _extracted_map(field, entry_delimiter, key_delimiter)

    def to_map(entries):
        keys = F.transform(entries, _key)
        return F.when(
            F.size(F.array_distinct(keys)) == F.size(entries),
            F.map_from_arrays(keys, F.transform(entries, _value)),
        ).otherwise(_let(F.sort_array(F.transform(entries, _placed)), _last_of_each_key))

    split_key = split_pattern(key_delimiter)
    entries = split_dropping_trailing(field, entry_delimiter)
    return _let(F.transform(entries, lambda entry: F.split(entry, split_key)), to_map)


def _extracted_map(field: Column, entry_delimiter: str, key_delimiter: str) -> Column:
    """The same where both delimiters are one character: keys and values are extracted in two passes of
    a pattern over the text, in which every entry is led by a delimiter."""
    stripped = strip_trailing(field, entry_delimiter)
    entry, key = (f"\\x{{{ord(c):x}}}" for c in (entry_delimiter, key_delimiter))
    pattern = F.lit(f"{entry}([^{entry}{key}]*)(?:{key}([^{entry}{key}]*))?[^{entry}]*")
    text = F.concat(F.lit(entry_delimiter), stripped)
    parts = F.array(F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2)))

    def to_map(found: Column) -> Column:
        keys, values = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        placed = F.arrays_zip(keys, F.sequence(F.lit(1), F.size(keys)), values)
        placed = placed.cast("array<struct<key:string,position:int,value:string>>")
        # No function here uses a variable of the one around it: Python functions over such a map
        # would not be found by the planner.
        return F.when(
            F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)
        ).otherwise(_let(F.sort_array(placed), _last_of_each_key))

    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.when((stripped == "") & (field != ""), empty).otherwise(_let(parts, to_map))


def _key(entry: Column) -> Column:
    return F.get(entry, F.lit(0))


def _value(entry: Column) -> Column:
    return F.coalesce(F.get(entry, F.lit(1)), F.lit(""))


def _placed(entry: Column, position: Column) -> Column:
    return F.struct(
        _key(entry).alias("key"), position.alias("position"), _value(entry).alias("value")
    )


def _last_of_each_key(entries: Column) -> Column:
    """Entries sorted by key and position: one is the last of its key if the next key differs."""
    marked = F.zip_with(
        entries,
        F.slice(entries, F.lit(2), F.size(entries)),
        lambda this, after: F.when(
            ~F.coalesce(this["key"] == after["key"], F.lit(False)),
            F.struct(this["key"], this["value"]),
        ),
    )
    return F.map_from_entries(F.filter(marked, lambda entry: entry.isNotNull()))


def bad_map_entry(
    field: Column,
    entry_delimiter: str = ENTRY_DELIMITER,
    key_delimiter: str = KEY_DELIMITER,
) -> Column:
    """True if some entry of the map text is made of key delimiters only."""
    entry, key = split_pattern(entry_delimiter), split_pattern(key_delimiter)
    possible = field.startswith(key_delimiter) | field.contains(entry_delimiter + key_delimiter)
    return possible & field.rlike(f"(?:^|{entry})(?:{key})+(?:{entry}|\\z)")


def _rolled_date(text: Column) -> Column:
    """`yyyy-[m]m-[d]d` as date; days past the end of the month run into the next one."""
    month = F.concat(F.substring_index(text, "-", 2), F.lit("-1")).try_cast("date")
    day = F.substring_index(text, "-", -1).try_cast("int")
    return F.coalesce(text.try_cast("date"), F.date_add(month, day - 1))


def _time_text(text: Column) -> Column:
    """`h:m:sZ` as `HH:mm:ss`."""
    parts = F.split(F.rtrim(text, F.lit("Z")), ":")
    return F.concat_ws(":", *[F.lpad(F.get(parts, F.lit(i)), 2, "0") for i in range(3)])


def _timestamp(text: Column) -> Column:
    """`yyyy-m-d[T ]h:m:s[.f]Z` as the wall clock it spells, without a zone."""
    clock = F.translate(F.rtrim(text, F.lit("Z")), "T", " ")
    rolled = F.concat_ws(
        " ",
        _rolled_date(F.substring_index(clock, " ", 1)).cast("string"),
        F.substring_index(clock, " ", -1),
    )
    return F.coalesce(clock.try_cast("timestamp_ntz"), rolled.try_cast("timestamp_ntz"))


def is_time(field: T.StructField) -> bool:
    """Whether a string column is declared as a time of day."""
    return field.metadata.get("kind") == "time"


def convert(
    text: Column,
    field: T.StructField,
    entry_delimiter: str = ENTRY_DELIMITER,
    key_delimiter: str = KEY_DELIMITER,
) -> tuple[Column, Column]:
    """The typed value of a text field, and whether the text is valid for the type.

    The value is null where the text is null or invalid.
    """
    kind = field.dataType

    def guarded(pattern: str, value: Column) -> tuple[Column, Column]:
        value = F.when(text.rlike(pattern), value)
        return value, text.isNull() | value.isNotNull()

    if isinstance(kind, T.NullType):
        return F.lit(None).cast(kind), F.lit(True)
    if isinstance(kind, T.BooleanType):
        return F.lower(text) == "true", F.lit(True)
    if isinstance(kind, T.StringType):
        return guarded(TIME_TEXT, _time_text(text)) if is_time(field) else (text, F.lit(True))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return guarded(INTEGER_TEXT, text.try_cast(kind))
    if isinstance(kind, T.DecimalType) and kind.scale == 0:
        return guarded(INTEGER_TEXT, text.try_cast("bigint").try_cast(kind))
    if isinstance(kind, T.DecimalType):
        value = text.try_cast("double").try_cast(kind)
        return value, text.isNull() | value.isNotNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = text.try_cast(kind)
        return value, text.isNull() | value.isNotNull()
    if isinstance(kind, T.DateType):
        return guarded(DATE_TEXT, _rolled_date(text))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return guarded(TIMESTAMP_TEXT, _timestamp(text).cast(kind))
    if isinstance(kind, T.MapType) and kind.keyType == kind.valueType == T.StringType():
        valid = ~F.coalesce(bad_map_entry(text, entry_delimiter, key_delimiter), F.lit(False))
        return F.when(valid, string_map(text, entry_delimiter, key_delimiter)), valid
    raise TypeError(f"column {field.name}: delimited text has no {kind.simpleString()} fields")


def delimited_columns(
    parts: Column,
    schema: T.StructType,
    *,
    mode: str = "FAILFAST",
    check_all: bool = False,
    entry_delimiter: str = ENTRY_DELIMITER,
    key_delimiter: str = KEY_DELIMITER,
) -> list[Column]:
    """One column per schema field, taken by position from the split message `parts`.

    Missing fields are null, fields beyond the schema are ignored. FAILFAST raises on an invalid
    field; PERMISSIVE makes the whole row null. By default FAILFAST looks only at the columns a
    query uses; `check_all` makes every column look at all of them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    decoded = []
    for i, field in enumerate(schema.fields):
        text = F.get(parts, F.lit(i))
        value, valid = convert(text, field, entry_delimiter, key_delimiter)
        decoded.append((field, text, value, valid))

    row_valid = reduce(lambda a, b: a & b, (valid for *_, valid in decoded), F.lit(True))
    columns = []
    for field, text, value, valid in decoded:
        if mode == "PERMISSIVE":
            value = F.when(row_valid, value)
        else:
            problem = F.concat(
                F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "),
                F.coalesce(text, F.lit("(another field of the message is invalid)")),
            )
            failure = F.raise_error(problem).cast(field.dataType)
            if check_all:
                value = F.when(row_valid, value).otherwise(failure)
            elif not isinstance(field.dataType, T.NullType):
                value = F.coalesce(value, F.when(text.isNotNull(), failure))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return columns
