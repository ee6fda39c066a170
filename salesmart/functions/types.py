"""The least type that holds the values of two columns, for tables whose sources change a column's type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole-number types from narrow to wide, with the digits of their largest value.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point, of whole and decimal numbers."""
    if kind in WHOLE:
        return WHOLE[kind], 0
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type in which every value of both keeps its digits; text where there is no other.

    Whole numbers meet in the wider one, with decimals in a decimal that has room for both; floats meet whole numbers that a
    double holds exactly in double. A date meets a timestamp in the timestamp. Nested types meet only themselves.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if any(isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for kind in (a, b)):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.__getitem__)
    left, right = _digits(a), _digits(b)
    if left and right:
        before, after = max(left[0], right[0]), max(left[1], right[1])
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else T.StringType()
    floats = [kind for kind in (a, b) if isinstance(kind, (T.FloatType, T.DoubleType))]
    others = [kind for kind in (a, b) if kind not in floats]
    if floats and all(kind in WHOLE and WHOLE[kind] <= 10 for kind in others):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def widened_fields(stored: T.StructType, incoming: T.StructType) -> dict[str, T.DataType]:
    """The columns of ``stored`` that need another type to hold ``incoming``, with that type."""
    wanted = {f.name: common_type(f.dataType, incoming[f.name].dataType) for f in stored.fields if f.name in incoming.names}
    return {name: kind for name, kind in wanted.items() if kind != stored[name].dataType}


def as_type(column: str, kind: T.DataType, wanted: T.DataType) -> Column:
    return F.col(f"`{column}`") if kind == wanted else F.col(f"`{column}`").cast(wanted).alias(column)


def aligned(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of both, in the order of ``left`` and then ``right``, each column in the common type.

    A column that one frame lacks is NULL there.
    """
    schemas = (left.schema, right.schema)
    names = list(dict.fromkeys([*left.columns, *right.columns]))

    def kind_of(name: str) -> T.DataType:
        kinds = [s[name].dataType for s in schemas if name in s.names]
        return kinds[0] if len(kinds) == 1 else common_type(*kinds)

    kinds = {name: kind_of(name) for name in names}

    def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
        return df.select([
            as_type(n, schema[n].dataType, kinds[n]) if n in schema.names else F.lit(None).cast(kinds[n]).alias(n) for n in names])

    return conformed(left, schemas[0]), conformed(right, schemas[1])
