"""Schemas that are made one, and the casts to them."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topictables import SchemaConflict, evolved, unified

ATOMS = [T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.StringType(), T.BinaryType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.NullType()]


def kinds(depth=2):
    atoms = st.sampled_from(ATOMS)
    if not depth:
        return atoms
    inner = kinds(depth - 1)
    fields = st.dictionaries(st.sampled_from("abcd"), st.tuples(inner, st.booleans()), min_size=1, max_size=3)
    records = fields.map(lambda d: T.StructType([T.StructField(n, k, null) for n, (k, null) in d.items()]))
    return atoms | st.builds(T.ArrayType, inner, st.booleans()) | st.builds(lambda v, null: T.MapType(T.StringType(), v, null), inner, st.booleans()) | records


def sorted_fields(kind):
    if isinstance(kind, T.StructType):
        return T.StructType(sorted((T.StructField(f.name, sorted_fields(f.dataType), f.nullable) for f in kind.fields), key=lambda f: f.name))
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(sorted_fields(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, sorted_fields(kind.valueType), kind.valueContainsNull)
    return kind


def united(one, other):
    try:
        return sorted_fields(unified(one, other))
    except SchemaConflict:
        return None


@settings(max_examples=400, deadline=None)
@given(kinds(), kinds())
def test_order_does_not_matter_and_nothing_changes_twice(one, other):
    both = united(one, other)
    assert both == united(other, one)
    assert united(one, one) == sorted_fields(one)
    if both is not None:
        assert united(both, one) == both and united(both, other) == both


@settings(max_examples=200, deadline=None)
@given(kinds(1), kinds(1), kinds(1))
def test_three_schemas_in_any_grouping(a, b, c):
    left = united(a, b)
    right = united(b, c)
    if left is not None and right is not None:
        assert united(left, c) == united(a, right)


def test_conflicts_name_the_place():
    one = T.StructType.fromDDL("a struct<b:array<struct<c:int>>>")
    other = T.StructType.fromDDL("a struct<b:array<struct<c:string>>>")
    with pytest.raises(SchemaConflict, match=r"a.b\[\].c: int and string") as found:
        unified(one, other)
    assert found.value.path == "a.b[].c"
    with pytest.raises(SchemaConflict, match="m{}"):
        unified(T.StructType.fromDDL("m map<string,int>"), T.StructType.fromDDL("m map<string,boolean>"))
    with pytest.raises(ValueError, match="two fields"):
        unified(one, T.StructType.fromDDL("a int, z int"), {"z": "a"})


def test_casts(spark):
    have = T.StructType.fromDDL("k int, who string, p struct<x:int>, l array<struct<n:int>>, m map<string,float>")
    new = T.StructType.fromDDL("k bigint, name string, p struct<x:double,y:string>, l array<struct<n:bigint,o:int>>, m map<string,double>, more date")
    want = unified(new, have, {"who": "name"})
    assert want.simpleString() == "struct<k:bigint,name:string,p:struct<x:double,y:string>,l:array<struct<n:bigint,o:int>>,m:map<string,double>,more:date>"
    rows = spark.createDataFrame([(1, "a", (2,), [(3,), None], {"z": 0.5}), (None, None, None, None, None)], have)
    record = evolved(F.struct("*"), have, want, {"who": "name"}, {"p.y": "none", "l[].o": 7})
    got = [r[0].asDict(recursive=True) for r in rows.select(record).collect()]
    assert got[0] == {"k": 1, "name": "a", "p": {"x": 2.0, "y": "none"}, "l": [{"n": 3, "o": 7}, None], "m": {"z": 0.5}, "more": None}
    assert got[1] == {"k": None, "name": None, "p": None, "l": None, "m": None, "more": None}
    with pytest.raises(SchemaConflict, match="k"):
        evolved(F.struct("*"), have, T.StructType.fromDDL("k boolean"))
