"""Widening of column types across files that drifted apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def unify_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Narrowest type that holds both without loss of range; text where there is no common number."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return T.LongType()
    if isinstance(a, _INTEGERS + _FLOATS) and isinstance(b, _INTEGERS + _FLOATS):
        return T.DoubleType()
    return T.StringType()


def _merge_two(base: T.StructType, new: T.StructType) -> T.StructType:
    types = {f.name: f.dataType for f in base}
    for field in new:
        types[field.name] = unify_type(types[field.name], field.dataType) if field.name in types else field.dataType
    known = sorted(base.names)
    added = sorted(n for n in new.names if n not in set(known))
    return T.StructType([T.StructField(n, types[n], True) for n in known + added])


def merge_schemas(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all: columns of earlier schemas by name, then the ones only later schemas have."""
    return reduce(_merge_two, schemas)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to `schema`, with nulls for columns `df` lacks."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
