"""Operations on the leaves of nested score columns (structs and arrays of numbers)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def leaves(schema: DataType, prefix: str = "") -> list[str]:
    """Dotted paths of the leaves of a type; arrays count as one leaf."""
    if not isinstance(schema, StructType):
        return [prefix]
    return [p for f in schema.fields for p in leaves(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]


def map_leaves(column: Column, schema: DataType, change: Callable[[Column], Column]) -> Column:
    """The same shape with every leaf changed, inside arrays as well."""
    if isinstance(schema, StructType):
        fields = [map_leaves(column[f.name], f.dataType, change).alias(f.name) for f in schema.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(schema, ArrayType):
        return F.transform(column, lambda x: map_leaves(x, schema.elementType, change))
    return change(column)


def leaf_length(column: Column, schema: DataType) -> Column:
    """Length of the first array among the leaves; 1 where there is none."""
    while isinstance(schema, StructType):
        column, schema = column[schema.fields[0].name], schema.fields[0].dataType
    return F.size(column) if isinstance(schema, ArrayType) else F.lit(1)


def leaf_item(column: Column, schema: DataType, index: int) -> Column:
    """The same shape with every array leaf replaced by its item at ``index`` (null beyond its end)."""
    if isinstance(schema, StructType):
        return F.struct(*[leaf_item(column[f.name], f.dataType, index).alias(f.name) for f in schema.fields])
    return F.get(column, index) if isinstance(schema, ArrayType) else column


def long_leaves(column: Column, schema: DataType) -> Column:
    """An array of (path, value) of the numeric leaves, to explode into the long score table."""

    def at(path: str) -> Column:
        out = column
        for part in path.split("."):
            out = out[part]
        return out

    return F.array(*[F.struct(F.lit(p).alias("metric"), at(p).cast("double").alias("score")) for p in leaves(schema)])
