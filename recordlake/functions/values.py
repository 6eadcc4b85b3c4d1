"""Small expressions shared by staging and unification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_value(items: Column, field: str) -> Column:
    """``items[0].field``; null for a null or empty list (also under ANSI)."""
    return F.get(items, F.lit(0)).getField(field)


def text(column: Column) -> Column:
    return column.cast("string")


def null_of(data_type: T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def list_of_one_null_struct(data_type: T.ArrayType) -> Column:
    """A one-element list whose struct has every field null."""
    fields = [null_of(f.dataType).alias(f.name) for f in data_type.elementType.fields]
    return F.array(F.struct(*fields)).cast(data_type)


def with_declared_fields(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` with every field that ``want`` declares, at any depth, in lists too.

    A missing field is a typed null in each object; fields of its own stay, and
    so does a value's type where both have it. A null object or list stays
    null. A value that is no object or list where one is declared becomes null.
    """
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            return null_of(want)
        own, fields = {f.name: f.dataType for f in want.fields}, []
        for f in have.fields:
            value = column.getField(f.name)
            if f.name in own:
                value = with_declared_fields(value, f.dataType, own[f.name])
            fields.append(value.alias(f.name))
        fields += [null_of(t).alias(name) for name, t in own.items() if name not in have.names]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        if not isinstance(have, T.ArrayType):
            return null_of(want)
        if declares(have.elementType, want.elementType):
            return column
        return F.transform(
            column, lambda v: with_declared_fields(v, have.elementType, want.elementType)
        )
    return column


def declares(have: T.DataType, want: T.DataType) -> bool:
    """Whether ``have`` holds every object, list and field of ``want``."""
    if isinstance(want, T.StructType):
        return isinstance(have, T.StructType) and all(
            f.name in have.names and declares(have[f.name].dataType, f.dataType) for f in want.fields
        )
    if isinstance(want, T.ArrayType):
        return isinstance(have, T.ArrayType) and declares(have.elementType, want.elementType)
    return True


def measured_summary(value: Column, unit: Column, coded: Column, free_text: Column) -> Column:
    """``value unit`` when both are known, else the coded text, else the free text."""
    return F.when(
        value.isNotNull() & unit.isNotNull(), F.concat(text(value), F.lit(" "), unit)
    ).otherwise(F.when(coded.isNotNull(), coded).otherwise(free_text))
