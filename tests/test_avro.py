"""Avro codec, against the Avro library Spark itself ships and against literal bytes."""

import json
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from checks.messages import SHIPMENT
from topictables import avro_table
from topictables.functions import avro_arrow
from topictables.functions.avro import from_avro_message, record_node, to_avro_message
from topictables.plans.schema import avro_schema, avro_text

NESTED = json.dumps(SHIPMENT)
NESTED_JSON = {
    "order": 71,
    "flags": ["R", "F"],
    "cents": {"price": 250},
    "stops": [{"status": "open", "day": 12}, {"status": "done", "day": 15}],
    "quantity": {"double": 4.5},
    "labels": {"mode": "rail", "port": ""},
    "parties": {"part": {"number": 7}},
    "remark": {"string": "späť"},
}

EVERYTHING = json.dumps(
    {
        "type": "record",
        "name": "Everything",
        "fields": [
            {"name": "b", "type": "boolean"},
            {"name": "i", "type": "int"},
            {"name": "l", "type": "long"},
            {"name": "f", "type": "float"},
            {"name": "d", "type": "double"},
            {"name": "s", "type": "string"},
            {"name": "raw", "type": "bytes"},
            {"name": "e", "type": {"type": "enum", "name": "Color", "symbols": ["RED", "BLUE"]}},
            {"name": "x", "type": {"type": "fixed", "name": "Two", "size": 2}},
            {"name": "n", "type": ["string", "null"]},
            {"name": "doubles", "type": {"type": "array", "items": "double"}},
            {"name": "longs", "type": {"type": "array", "items": "long"}},
            {
                "name": "grid",
                "type": {"type": "array", "items": {"type": "array", "items": "int"}},
            },
            {"name": "maybe", "type": ["null", {"type": "array", "items": ["null", "long"]}]},
            {
                "name": "rec",
                "type": [
                    "null",
                    {
                        "type": "record",
                        "name": "Inner",
                        "fields": [
                            {"name": "c", "type": "Color"},
                            {"name": "m", "type": {"type": "map", "values": ["null", "double"]}},
                        ],
                    },
                ],
            },
        ],
    }
)
EVERYTHING_JSON = [
    {
        "b": True, "i": -5, "l": 1 << 40, "f": 1.5, "d": -2.25, "s": "é漢", "raw": "\u0001ÿ",
        "e": "BLUE", "x": "ab", "n": {"string": "q"}, "doubles": [1.0, 2.5], "longs": [0, -1, 300, 1 << 62],
        "grid": [[1, 2], [], [3]], "maybe": {"array": [None, {"long": 7}]},
        "rec": {"Inner": {"c": "RED", "m": {"a": None, "b": {"double": 0.5}}}},
    },
    {
        "b": False, "i": 2147483647, "l": -(1 << 63), "f": 0.0, "d": 0.0, "s": "", "raw": "",
        "e": "RED", "x": "zz", "n": None, "doubles": [], "longs": [], "grid": [], "maybe": None,
        "rec": None,
    },
    {
        "b": True, "i": 0, "l": 64, "f": -0.5, "d": 1e300, "s": "x" * 200, "raw": "abc",
        "e": "RED", "x": "00", "n": {"string": ""}, "doubles": [3.0], "longs": [5],
        "grid": [[], [9, 8, 7]], "maybe": {"array": []},
        "rec": {"Inner": {"c": "BLUE", "m": {}}},
    },
]


def java_encode(spark, schema: str, datum_json: dict, block: bool = False) -> bytes:
    """Bytes from the Avro library on Spark's class path."""
    jvm = spark._jvm
    java_schema = jvm.org.apache.avro.Schema.Parser().parse(schema)
    factory = jvm.org.apache.avro.io.DecoderFactory.get()
    datum = jvm.org.apache.avro.generic.GenericDatumReader(java_schema).read(
        None, factory.jsonDecoder(java_schema, json.dumps(datum_json))
    )
    out = jvm.java.io.ByteArrayOutputStream()
    encoders = jvm.org.apache.avro.io.EncoderFactory()
    if block:
        encoder = encoders.configureBlockSize(64).blockingBinaryEncoder(out, None)
    else:
        encoder = encoders.binaryEncoder(out, None)
    jvm.org.apache.avro.generic.GenericDatumWriter(java_schema).write(datum, encoder)
    encoder.flush()
    return bytes(out.toByteArray())


def java_decode(spark, schema: str, message: bytes, reader: str | None = None) -> dict:
    jvm = spark._jvm
    writer = jvm.org.apache.avro.Schema.Parser().parse(schema)
    reader = jvm.org.apache.avro.Schema.Parser().parse(reader or schema)
    decoder = jvm.org.apache.avro.io.DecoderFactory.get().binaryDecoder(message, None)
    datum = jvm.org.apache.avro.generic.GenericDatumReader(writer, reader).read(None, decoder)
    return json.loads(datum.toString())


def decode_rows(spark, schema, messages, **options):
    df = spark.createDataFrame([(bytearray(m) if m is not None else None,) for m in messages], "value binary")
    df = df.coalesce(1)
    return df.select(from_avro_message(F.col("value"), schema, **options).alias("r"))


def plain(value):
    """Rows, maps and arrays as Python values."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return bytes(value) if isinstance(value, bytearray) else value


def test_nested_record(spark):
    message = java_encode(spark, NESTED, NESTED_JSON)
    (row,) = decode_rows(spark, NESTED, [message]).select("r.*").collect()
    assert plain(row) == NESTED_JSON | {"quantity": 4.5, "remark": "späť"}


def test_nested_schema():
    assert avro_schema(NESTED).simpleString() == (
        "struct<order:bigint,flags:array<string>,cents:map<string,int>,"
        "stops:array<struct<status:string,day:int>>,quantity:double,labels:map<string,string>,"
        "parties:map<string,struct<number:bigint>>,remark:string>"
    )
    nullable = [f.name for f in avro_schema(NESTED) if f.nullable]
    assert nullable == ["quantity", "remark"]


def test_top_level_unions_are_refused(spark):
    """The index in front of the record would be read as its first field."""
    record = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": "int"}]}
    union = ["null", record]
    message = java_encode(spark, json.dumps(union), {"R": {"a": 1, "b": 2}})
    assert message == bytes([2, 2, 4])
    (row,) = decode_rows(spark, json.dumps(record), [message[1:]]).collect()
    assert plain(row.r) == {"a": 1, "b": 2}
    for use in (record_node, avro_schema, lambda u: from_avro_message(F.col("value"), u), lambda u: to_avro_message(F.col("r"), u)):
        with pytest.raises(ValueError, match="union|needs an Avro record"):
            use(union)


def test_envelope_filters_pass_below_the_decoder(spark, tmp_path):
    path = str(tmp_path / "topic")
    message = java_encode(spark, NESTED, NESTED_JSON)
    rows = spark.range(20).select(F.col("id").alias("offset"), F.lit(bytearray(message)).alias("value"))
    rows.write.parquet(path)
    table = avro_table(spark.read.parquet(path), NESTED, columns=["order", "labels"], keep=["offset"])
    assert table.columns == ["offset", "order", "labels"]
    kept = table.filter("offset > 5 and order = 71")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(offset,5)" in plan[plan.index("PushedFilters") :]
    assert plan.count("ArrowEvalPython") == 1
    assert kept.count() == 14
    with pytest.raises(ValueError, match="no field zzz"):
        avro_table(spark.read.parquet(path), NESTED, columns=["zzz"])


def test_null_records_give_no_message(spark):
    schema = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}
    rows = spark.sql("SELECT if(id = 1, null, named_struct('a', id)) AS r FROM VALUES (0), (1), (2) AS t(id)")
    sent = [r[0] for r in rows.select(to_avro_message(F.col("r"), schema)).collect()]
    assert [m and bytes(m) for m in sent] == [b"\0", None, b"\4"]


def test_items_without_bytes_and_small_decimals_are_refused():
    empty = {"type": "record", "name": "E", "fields": []}
    small = {"type": "fixed", "name": "F", "size": 3, "logicalType": "decimal", "precision": 7, "scale": 0}
    for kind, problem in (({"type": "array", "items": empty}, "without bytes"), (small, "do not hold 7")):
        with pytest.raises(ValueError, match=problem):
            record_node({"type": "record", "name": "R", "fields": [{"name": "x", "type": kind}]})


def test_slices_see_their_own_bytes(monkeypatch):
    node = record_node({"type": "record", "name": "R", "fields": [{"name": "s", "type": {"type": "array", "items": "int"}}]})
    rows = pa.array([{"s": list(range(n % 7))} for n in range(400)], avro_arrow.empty_of(node))
    messages = avro_arrow.encode(node, rows)
    seen = []
    batch = avro_arrow.Batch
    monkeypatch.setattr(avro_arrow, "Batch", lambda m: seen.append(batch(m)) or seen[-1])
    pieces = [avro_arrow.decode(node, messages.slice(at, 100)) for at in range(0, 400, 100)]
    assert pa.concat_arrays(pieces).to_pylist() == rows.to_pylist()
    assert sum(len(b.bytes) for b in seen) == sum(len(m.as_py()) for m in messages)


def test_literal_bytes(spark):
    schema = json.dumps(
        {"type": "record", "name": "R", "fields": [
            {"name": "a", "type": "long"}, {"name": "s", "type": "string"},
            {"name": "u", "type": ["null", "int"]}, {"name": "l", "type": {"type": "array", "items": "int"}},
        ]}
    )
    # 64 -> 80 01; "hi" -> 04 68 69; branch 1, -1 -> 02 01; [1, 2] -> 04 02 04, end 00
    message = bytes([0x80, 0x01, 0x04, 0x68, 0x69, 0x02, 0x01, 0x04, 0x02, 0x04, 0x00])
    (row,) = decode_rows(spark, schema, [message]).select("r.*").collect()
    assert plain(row) == {"a": 64, "s": "hi", "u": -1, "l": [1, 2]}
    # the same array as a block with negative count and byte size, then a second block
    blocks = message[:7] + bytes([0x01, 0x02, 0x02, 0x02, 0x04, 0x00])
    (row,) = decode_rows(spark, schema, [blocks]).select("r.l").collect()
    assert row.l == [1, 2]


@pytest.mark.parametrize("block", [False, True])
def test_every_type_decodes_like_the_avro_library(spark, block):
    messages = [java_encode(spark, EVERYTHING, datum, block) for datum in EVERYTHING_JSON]
    rows = decode_rows(spark, EVERYTHING, messages * 3).select("r.*").collect()
    assert [plain(r) for r in rows[:3]] == [plain(r) for r in rows[3:6]]
    for row, datum in zip(rows, EVERYTHING_JSON, strict=False):
        got = plain(row)
        assert got["raw"] == datum["raw"].encode("latin-1")
        assert got["x"] == datum["x"].encode("latin-1")
        for name in ("b", "i", "l", "f", "d", "s", "e", "doubles", "longs", "grid"):
            assert got[name] == datum[name], name
        assert got["n"] == (datum["n"] and datum["n"]["string"])
    assert plain(rows[0])["maybe"] == [None, 7]
    assert plain(rows[0])["rec"] == {"c": "RED", "m": {"a": None, "b": 0.5}}
    assert plain(rows[1])["maybe"] is None and plain(rows[1])["rec"] is None
    assert plain(rows[2])["maybe"] == [] and plain(rows[2])["rec"] == {"c": "BLUE", "m": {}}


def test_every_type_encodes_like_the_avro_library(spark):
    messages = [java_encode(spark, EVERYTHING, datum) for datum in EVERYTHING_JSON]
    decoded = decode_rows(spark, EVERYTHING, messages)
    again = decoded.select(to_avro_message(F.col("r"), EVERYTHING).alias("m")).collect()
    for before, after in zip(messages, again, strict=True):
        assert java_decode(spark, EVERYTHING, bytes(after.m)) == java_decode(
            spark, EVERYTHING, before
        )
        assert len(after.m) == len(before)


def test_narrowed_record_skips_other_fields(spark):
    messages = [java_encode(spark, EVERYTHING, datum) for datum in EVERYTHING_JSON]
    narrowed = decode_rows(spark, EVERYTHING, messages, columns=["l", "rec"])
    assert narrowed.select("r.*").columns == ["l", "rec"]
    assert [r.l for r in narrowed.select("r.l").collect()] == [d["l"] for d in EVERYTHING_JSON]
    with pytest.raises(ValueError, match="no field zzz"):
        from_avro_message(F.col("value"), EVERYTHING, columns=["zzz"])


def test_narrowed_schema_reads_with_the_avro_library(spark):
    """The reader schema for Spark's Avro module; a kept field names a type a dropped one defines."""
    node = record_node(EVERYTHING)
    kept = [f for f in node["fields"] if f["name"] in ("l", "rec", "x")]
    narrowed = avro_text(dict(node, fields=kept))
    message = java_encode(spark, EVERYTHING, EVERYTHING_JSON[0])
    datum = java_decode(spark, EVERYTHING, message, narrowed)
    assert datum["l"] == 1 << 40 and datum["rec"]["c"] == "RED" and list(datum) == ["l", "x", "rec"]
    assert json.loads(avro_text(record_node(NESTED)))["name"] == "example.orders.Shipment"


def test_broken_messages(spark):
    good = java_encode(spark, NESTED, NESTED_JSON)
    broken = [good, good[:-4], b"", good, b"\xff" * 30]
    with pytest.raises(Exception, match="message ends|out of range|empty message"):
        decode_rows(spark, NESTED, broken).collect()
    rows = decode_rows(spark, NESTED, broken, mode="PERMISSIVE").collect()
    assert [r.r is None for r in rows] == [False, True, True, False, True]
    assert rows[3].r.stops[1].status == "done"


def test_random_damage_never_spoils_good_messages(spark):
    """Damaged messages raise or decode to something; their neighbours are untouched."""
    node = record_node(EVERYTHING)
    good = [java_encode(spark, EVERYTHING, datum) for datum in EVERYTHING_JSON]
    expected = avro_arrow.decode(node, pa.array(good, pa.binary())).to_pylist()
    random = np.random.default_rng(7)
    for _ in range(150):
        batch, kept = [], []
        for _ in range(12):
            which = int(random.integers(len(good)))
            message = bytearray(good[which])
            damage = random.integers(4)
            if damage == 1:
                message[random.integers(len(message))] = random.integers(256)
            elif damage == 2:
                message = message[: random.integers(len(message))]
            elif damage == 3:
                at = random.integers(len(message))
                message[at:at] = random.bytes(int(random.integers(1, 12)))
            kept.append(expected[which] if damage == 0 else None)
            batch.append(bytes(message))
        rows = avro_arrow.decode(node, pa.array(batch, pa.binary()), permissive=True)
        assert len(rows) == len(batch)
        for i, (message, want) in enumerate(zip(batch, kept, strict=True)):
            assert want is None or rows[i].as_py() == want
            try:
                alone = avro_arrow.decode(node, pa.array([message], pa.binary()))[0]
            except ValueError:
                alone = None
            assert rows[i].is_valid == (alone is not None)
            try:
                assert alone is None or repr(rows[i].as_py()) == repr(alone.as_py())
            except UnicodeDecodeError:
                pass  # damage inside a string


def test_counts_and_lengths_beyond_the_message():
    node = record_node(
        {"type": "record", "name": "R", "fields": [
            {"name": "a", "type": {"type": "array", "items": "double"}},
            {"name": "s", "type": "string"},
        ]}
    )
    huge = avro_arrow.varints(np.array([2**62, -(2**63)]))
    for message in (huge[0].as_py(), b"\0" + huge[0].as_py(), huge[1].as_py() + b"\2", b""):
        with pytest.raises(ValueError):
            avro_arrow.decode(node, pa.array([message], pa.binary()))


def test_bytes_after_the_record_are_ignored(spark):
    good = java_encode(spark, NESTED, NESTED_JSON)
    (row,) = decode_rows(spark, NESTED, [good + b"tail"]).collect()
    assert row.r.order == 71


def test_repeated_map_key_keeps_the_last_entry(spark):
    schema = json.dumps(
        {"type": "record", "name": "R", "fields": [{"name": "m", "type": {"type": "map", "values": "int"}}]}
    )
    message = bytes([0x06, 0x02, 0x61, 0x02, 0x02, 0x62, 0x04, 0x02, 0x61, 0x06, 0x00])
    (row,) = decode_rows(spark, schema, [message]).select("r.m").collect()
    assert row.m == {"a": 3, "b": 2}


def test_null_in_a_required_field_raises(spark):
    schema = json.dumps(
        {"type": "record", "name": "R", "fields": [{"name": "name", "type": "string"}]}
    )
    df = spark.sql("SELECT named_struct('name', cast(null AS string)) AS r")
    with pytest.raises(Exception, match="name: null in a required"):
        df.select(to_avro_message(F.col("r"), schema)).collect()


def test_unions_of_several_types_are_refused():
    schema = {"type": "record", "name": "R", "fields": [{"name": "u", "type": ["int", "string"]}]}
    with pytest.raises(ValueError, match="one other type"):
        record_node(schema)


def test_recursive_records_are_refused():
    schema = {"type": "record", "name": "R", "fields": [{"name": "next", "type": ["null", "R"]}]}
    with pytest.raises(ValueError, match="contains itself"):
        record_node(schema)


def test_logical_types(spark):
    schema = json.dumps(
        {"type": "record", "name": "R", "fields": [
            {"name": "day", "type": {"type": "int", "logicalType": "date"}},
            {"name": "ms", "type": {"type": "long", "logicalType": "timestamp-millis"}},
            {"name": "us", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
            {"name": "dec", "type": {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 2}},
            {"name": "fix", "type": {"type": "fixed", "name": "F", "size": 9, "logicalType": "decimal",
                                     "precision": 21, "scale": 3}},
        ]}
    )
    df = spark.sql(
        """SELECT named_struct('day', date'2018-05-19', 'ms', timestamp'2018-05-19 01:02:03.123',
             'us', timestamp_ntz'1960-01-01 00:00:00.000001', 'dec', cast(d AS decimal(20,2)),
             'fix', cast(d AS decimal(21,3))) AS r
           FROM VALUES (0.00), (-1.28), (1.27), (1.28), (-123456789012345678.91), (655.36) AS t(d)"""
    )
    coded = df.select("r", to_avro_message(F.col("r"), schema).alias("m"))
    back = coded.select("r", from_avro_message(F.col("m"), schema).alias("q"), "m").collect()
    for row in back:
        assert row.r == row.q
    assert bytes(back[1].m)[-11:] == b"\x02\x80" + (-1280).to_bytes(9, "big", signed=True)
    assert back[4].q.dec == Decimal("-123456789012345678.91")


@settings(max_examples=40, deadline=None)
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "l": st.integers(-(2**63), 2**63 - 1),
                "s": st.none() | st.text(max_size=20),
                "m": st.dictionaries(st.text(max_size=3), st.lists(st.integers(-9, 9999), max_size=4)),
                "a": st.none() | st.lists(st.none() | st.floats(allow_nan=False), max_size=5),
            }
        ),
        min_size=1,
        max_size=12,
    )
)
def test_round_trip_of_random_batches(rows):
    node = record_node(
        {"type": "record", "name": "R", "fields": [
            {"name": "l", "type": "long"},
            {"name": "s", "type": ["null", "string"]},
            {"name": "m", "type": {"type": "map", "values": {"type": "array", "items": "int"}}},
            {"name": "a", "type": ["null", {"type": "array", "items": ["double", "null"]}]},
        ]}
    )
    column = pa.array(
        [dict(r, m=list(r["m"].items())) for r in rows], avro_arrow.empty_of(node)
    )
    for part in (column, column.slice(1)):
        messages = avro_arrow.encode(node, part)
        decoded = avro_arrow.decode(node, messages)
        assert decoded.to_pylist() == part.to_pylist()
        decoded.validate(full=True)


def test_varints_cover_the_long_range():
    values = np.array([0, -1, 1, 63, 64, -64, -65, 2**31, -(2**31), 2**63 - 1, -(2**63)])
    lengths = [1, 1, 1, 1, 2, 1, 2, 5, 5, 10, 10]
    assert [len(v.as_py()) for v in avro_arrow.varints(values)] == lengths
