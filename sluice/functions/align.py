"""Copying between record types by field name and exact type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def type_default(data_type: T.DataType) -> Column:
    """Value of an untouched field: 0 for numbers, NULL otherwise."""
    value = 0 if isinstance(data_type, T.NumericType) else None
    return F.lit(value).cast(data_type)


def shared_fields(source: T.StructType, target: T.StructType) -> list[str]:
    """Target fields the source has under the same name with the same type."""
    have = {f.name: f.dataType for f in source}
    return [f.name for f in target if have.get(f.name) == f.dataType]


def align(
    df: DataFrame, target: T.StructType, fill: Mapping[str, Column] | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` in the shape of ``target``, as one projection.

    A field with the same name and exact type is copied, NULLs included. The others take
    ``fill[name]``, else the type's default. ``carry`` columns follow as they are.
    """
    fill = fill or {}
    copied = set(shared_fields(df.schema, target))
    columns = []
    for field in target:
        if field.name in copied:
            value = F.col(field.name)
        elif field.name in fill:
            value = fill[field.name].cast(field.dataType)
        else:
            value = type_default(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *carry)


def overlay(
    target: T.StructType, layers: list[tuple[Column, T.StructType]], all_present: bool = False
) -> list[Column]:
    """Columns of ``target`` from struct columns laid over each other, the last one on top.

    A layer gives every field it shares with the target, NULLs included, wherever its struct is
    present; an absent layer leaves what lies below, at the bottom the type's default.
    ``all_present`` drops the presence tests.
    """
    columns = []
    for field in target:
        value = type_default(field.dataType)
        for struct, schema in layers:
            if field.name in shared_fields(schema, target):
                top = struct[field.name]
                value = top if all_present else F.when(struct.isNotNull(), top).otherwise(value)
        columns.append(value.alias(field.name))
    return columns
