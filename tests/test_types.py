"""The type lattice that lets a stored table outlive a column's type."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import types as T

from salesmart.functions.types import aligned, common_type, widened_fields


KINDS = {"tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
         "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "void": T.NullType(), "array<int>": T.ArrayType(T.IntegerType())}


def kind(name):
    return KINDS[name] if name in KINDS else T.DecimalType(*map(int, name.removeprefix("decimal(").removesuffix(")").split(",")))


@pytest.mark.parametrize("a, b, wanted", [
    ("int", "int", "int"), ("tinyint", "bigint", "bigint"), ("smallint", "int", "int"), ("int", "string", "string"), ("string", "date", "string"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(10,5)", "string"), ("bigint", "decimal(4,2)", "decimal(21,2)"),
    ("float", "double", "double"), ("int", "double", "double"), ("bigint", "double", "string"), ("decimal(5,2)", "double", "string"), ("date", "timestamp", "timestamp"),
    ("boolean", "int", "string"), ("void", "int", "int"), ("array<int>", "array<int>", "array<int>"),
])
def test_common_type(a, b, wanted):
    assert common_type(kind(a), kind(b)) == common_type(kind(b), kind(a)) == kind(wanted)


def test_nested_types_meet_only_themselves():
    with pytest.raises(TypeError, match="no common type"):
        common_type(kind("array<int>"), kind("string"))


NAMES = ["tinyint", "smallint", "int", "bigint", "decimal(6,2)", "decimal(20,1)", "float", "double", "date", "timestamp", "boolean", "string"]


@pytest.mark.parametrize("a", NAMES)
@pytest.mark.parametrize("b", NAMES)
def test_a_widened_column_takes_both_types_again(a, b):
    """What a table was widened to holds the later batches of either type without widening again."""
    wide = common_type(kind(a), kind(b))
    assert common_type(wide, kind(a)) == common_type(wide, kind(b)) == wide


def test_values_survive(spark):
    left = spark.createDataFrame([(1, 10, "2020-01-02")], "k int, v int, d string").selectExpr("k", "v", "date(d) AS d")
    right = spark.createDataFrame([(2, "x1", 7)], "k bigint, v string, extra int")
    a, b = aligned(left, right)
    assert a.dtypes == b.dtypes == [("k", "bigint"), ("v", "string"), ("d", "date"), ("extra", "int")]
    assert rows(a.union(b).selectExpr("k", "v", "string(d) AS d", "extra")) == [(1, "10", "2020-01-02", None), (2, "x1", None, 7)]
    assert widened_fields(left.schema, right.schema) == {"k": T.LongType(), "v": T.StringType()}
    assert widened_fields(right.schema, left.schema) == {}
