"""Delimited messages, one literal message per rule."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topictables import delimited_table, table_schema

ITEM = table_schema(
    {
        "id": "INT",
        "name": "STRING",
        "count": "INT",
        "labels": T.MapType(T.StringType(), T.StringType()),
    }
)


def messages(spark, *values):
    rows = [(v.encode() if isinstance(v, str) else v,) for v in values]
    return spark.createDataFrame(rows, "value binary")


def decode(spark, value, schema=ITEM, **options):
    (row,) = delimited_table(messages(spark, value), schema, **options).collect()
    return tuple(row)


MESSAGES = [
    ("7\tink\t5\tcolour:blue,size:big", (7, "ink", 5, {"colour": "blue", "size": "big"})),
    ("1\ta", (1, "a", None, None)),
    ("1\ta\t\t", (1, "a", None, None)),
    ("1\t\t32", (1, "", 32, None)),
    ("\t\t\t", (None, None, None, None)),
    ("\t", (None, None, None, None)),
    ("1\ta\t32\tk:v\textra", (1, "a", 32, {"k": "v"})),
    ("1\ta\t32\ta:b:c,d,e:", (1, "a", 32, {"a": "b", "d": "", "e": ""})),
    ("1\ta\t32\ta:1,a:2", (1, "a", 32, {"a": "2"})),
    ("1\ta\t32\tb:0,a:1,c:5,a:2,b:,a:3", (1, "a", 32, {"a": "3", "b": "", "c": "5"})),
    ("1\ta\t32\t,", (1, "a", 32, {})),
    ("1\ta\t32\t,,a:1,,b:2,,", (1, "a", 32, {"": "", "a": "1", "b": "2"})),
    ("1\ta\t32\t\tx", (1, "a", 32, {"": ""})),
    ("1\ta\t32\t:v", (1, "a", 32, {"": "v"})),
    ("1\ta\t32\ta::c", (1, "a", 32, {"a": ""})),
    ("-1\ta\t+32", (-1, "a", 32, None)),
    ("1\tä漢\n\t32", (1, "ä漢\n", 32, None)),
    (b"1\ta\xff\t32", (1, "a�", 32, None)),
]


@pytest.mark.parametrize("options", [{}, {"mode": "PERMISSIVE"}, {"check_all": True}])
def test_messages(spark, options):
    texts = [message for message, _ in MESSAGES]
    rows = delimited_table(messages(spark, *texts).coalesce(1), ITEM, **options).collect()
    for (message, expected), row in zip(MESSAGES, rows, strict=True):
        assert tuple(row) == expected, message


@pytest.mark.parametrize(
    "message",
    ["", "1\ta\t\tk:v", "x\ta\t32", "1.5", " 1", "1 ", "1\n", "2147483648", "1\ta\t32\t:", "1\ta\t32\ta:1,::,b:2", None],
)
def test_invalid_messages(spark, message):
    with pytest.raises(Exception, match="not a|null message"):
        decode(spark, message)
    row = decode(spark, message, mode="PERMISSIVE")
    assert row == (None,) * 4


def test_empty_message_is_one_empty_field(spark):
    assert decode(spark, "", table_schema({"a": "STRING", "b": "STRING"})) == ("", None)


@pytest.mark.parametrize(
    "kind, message, expected",
    [
        ("BOOLEAN", "TRUE", True),
        ("BOOLEAN", "yes", False),
        ("LONG", "-9223372036854775808", -(2**63)),
        ("BIG_DEC", "30.5", Decimal("30.5")),
        ("BIG_DEC", "1e3", Decimal(1000)),
        ("BIG_INT", "9223372036854775807", Decimal(2**63 - 1)),
        ("SQL_DATE", "2018-05-19", datetime.date(2018, 5, 19)),
        ("SQL_DATE", "2018-2-3", datetime.date(2018, 2, 3)),
        ("SQL_DATE", "2018-02-31", datetime.date(2018, 3, 3)),
        ("SQL_TIME", "12:30:05Z", "12:30:05"),
        ("SQL_TIME", "1:2:3Z", "01:02:03"),
        ("SQL_TIMESTAMP", "2018-05-19T01:02:03.123Z", datetime.datetime(2018, 5, 19, 1, 2, 3, 123000)),
        ("SQL_TIMESTAMP", "2018-02-30 01:02:03Z", datetime.datetime(2018, 3, 2, 1, 2, 3)),
        ("FLOAT", "1.5", 1.5),
        ("DOUBLE", "-2.25", -2.25),
        ("VOID", "anything", None),
    ],
)
def test_types(spark, kind, message, expected):
    schema = table_schema({"first": "STRING", "value": kind})
    assert decode(spark, "x\t" + message, schema) == ("x", expected)
    assert decode(spark, "x", schema) == ("x", None)


@pytest.mark.parametrize(
    "kind, message",
    [
        ("LONG", "9223372036854775808"),
        ("BIG_DEC", "abc"),
        ("BIG_DEC", "NaN"),
        ("BIG_INT", "9223372036854775808"),
        ("SQL_DATE", "2018"),
        ("SQL_DATE", "2018-13-01"),
        ("SQL_DATE", "2018-01-32"),
        ("SQL_TIME", "12:30:05"),
        ("SQL_TIME", "12:30:05.1Z"),
        ("SQL_TIMESTAMP", "2018-05-19T01:02:03"),
        ("SQL_TIMESTAMP", "2018-05-19Z"),
    ],
)
def test_invalid_values(spark, kind, message):
    schema = table_schema({"value": kind, "after": "STRING"})
    with pytest.raises(Exception, match="column value: not a"):
        decode(spark, message + "\tx", schema)
    assert decode(spark, message + "\tx", schema, mode="PERMISSIVE") == (None, None)


@pytest.mark.parametrize("delimiters", ["|;=", ".*+", "\\^$", "a,:"])
def test_delimiters_are_literal(spark, delimiters):
    field, entry, key = delimiters
    options = {"field_delimiter": field, "entry_delimiter": entry, "key_delimiter": key}
    message = field.join(["1", "x-y", "32", entry.join([f"k{key}v", "d", f"k{key}w"])]) + field
    assert decode(spark, message, **options) == (1, "x-y", 32, {"k": "w", "d": ""})


def test_delimiters_of_several_characters(spark):
    options = {"field_delimiter": "||", "entry_delimiter": ";;", "key_delimiter": "=>"}
    assert decode(spark, "1||x|y||32||k=>v;;d;;||||", **options) == (1, "x|y", 32, {"k": "v", "d": ""})
    with pytest.raises(Exception, match="not a map"):
        decode(spark, "1||x|y||32||k=>v;;=>", **options)


def test_other_types_are_refused(spark):
    for kind in ("array<string>", "map<string,int>", "struct<a:int>"):
        with pytest.raises(TypeError, match="no .* fields"):
            delimited_table(messages(spark, "1"), table_schema({"c": kind}))


def test_unused_columns_are_not_parsed(spark):
    df = delimited_table(messages(spark, "x\ta\t32"), ITEM)
    assert [r.name for r in df.select("name").collect()] == ["a"]
    checked = delimited_table(messages(spark, "x\ta\t32"), ITEM, check_all=True)
    with pytest.raises(Exception, match="not a"):
        checked.select("name").collect()


def test_map_filter(spark):
    df = delimited_table(
        messages(spark, "7\tink\t5\tcolour:blue,size:big", "8\tpen\t6\tcolour:red", "9\tcap"), ITEM
    )
    assert [r.id for r in df.filter(F.col("labels")["colour"] == "blue").collect()] == [7]


def test_delimiters_that_overlap_themselves(spark):
    schema = table_schema({"a": "STRING", "b": "STRING", "c": "STRING"})
    cases = {"a|||": ("a", "|", None), "a||": ("a", None, None), "||||": (None, None, None), "": ("", None, None), "|||b": ("", "|b", None), "a||b||||": ("a", "b", None)}
    for message, expected in cases.items():
        assert decode(spark, message, schema, field_delimiter="||") == expected, message


def test_maps_by_one_character_and_by_several_agree(spark):
    import random

    from topictables.functions.delimited import bad_map_entry, string_map

    rng = random.Random(2)
    texts = ["".join(rng.choices("ab:,\n é", [3, 3, 3, 3, 1, 1, 1], k=rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(t, t.replace(",", ";;").replace(":", "==")) for t in texts], "one string, two string")
    valid = df.filter(~bad_map_entry(F.col("one")))
    rows = valid.select("one", string_map(F.col("one")).alias("a"), string_map(F.col("two"), ";;", "==").alias("b")).collect()
    assert len(rows) > 800 and any(len(r.a) > 2 for r in rows)
    for r in rows:
        assert r.a == r.b, r.one
        entries = [e.split(":") for e in r.one.rstrip(",").split(",")] if r.one.strip(",") or not r.one else []
        assert r.a == {e[0]: e[1] if len(e) > 1 else "" for e in entries}, r.one
