"""Typed staging: parse timestamps, fill missing columns, stamp the load."""

from __future__ import annotations

import datetime
import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.functions.times import load_stamp, parse_timestamp
from recordlake.functions.values import (
    declares,
    list_of_one_null_struct,
    null_of,
    with_declared_fields,
)
from recordlake.operators.keyed import BROADCAST_BYTES, attach
from recordlake.session import materialize

LOAD_STAMP = "medical_last_updated"
PARTICIPANT = "participant_id"


@dataclass(frozen=True)
class Rule:
    """What staging does with one column.

    ``patterns``: parse the text as a timestamp, first match wins; empty keeps
    the value. ``suffix``: text appended before parsing. ``absent``: what an
    input without the column gets: a type for a typed null (a list type for a
    list of one all-null object), a text for that marker, or None for nothing.
    A nested type also repairs a column that is there: objects without a field
    it declares get a null in its place, at any depth.
    """

    column: str
    patterns: tuple[str, ...] = ()
    suffix: str = ""
    absent: T.DataType | str | None = None

    def present(self, column: Column, data_type: T.DataType) -> Column:
        nested = isinstance(self.absent, (T.ArrayType, T.StructType))
        if nested and not declares(data_type, self.absent):
            return with_declared_fields(column, data_type, self.absent)
        if not self.patterns:
            return column
        text = F.concat(column, F.lit(self.suffix)) if self.suffix else column
        return parse_timestamp(text, *self.patterns)

    def missing(self) -> Column | None:
        if isinstance(self.absent, str):
            return F.lit(self.absent)
        if isinstance(self.absent, T.ArrayType):
            return list_of_one_null_struct(self.absent)
        return None if self.absent is None else null_of(self.absent)


@dataclass(frozen=True)
class StageSpec:
    resource_type: str
    rules: tuple[Rule, ...]


def stage(
    df: DataFrame,
    spec: StageSpec,
    *,
    participant: str | Column | None = None,
    as_of: str | datetime.datetime | None = None,
    input_id: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Apply ``spec`` to flattened records in one ``select``.

    ``participant``: a constant id, or the column that holds it; None leaves
    ``participant_id`` as it is.

    ``input_id``: set it when ``df`` holds many inputs at once. Whether a
    marker such as ``"----"`` applies is then decided per input, as if each
    were staged alone: an input in which the column never has a value gets
    the marker, and marked columns come out as text.
    """
    present = set(df.columns)
    marked = [
        rule.column
        for rule in spec.rules
        if isinstance(rule.absent, str) and rule.column in present
    ]
    has = {}
    if input_id is not None and marked:
        has = {column: f"_has_{i}" for i, column in enumerate(marked)}
        df = _attach_presence(df, has, input_id, broadcast_bytes)

    rules = {rule.column: rule for rule in spec.rules}
    columns: dict[str, Column] = {}
    for name in [c for c in df.columns if c in present]:
        column, rule = F.col(quoted(name)), rules.get(name)
        if rule is not None:
            column = rule.present(column, df.schema[name].dataType)
        if name in has:
            known = F.coalesce(F.col(has[name]), F.lit(True))
            column = F.when(known, column.cast("string")).otherwise(rule.missing())
        columns[name] = column
    for rule in spec.rules:
        if rule.column not in present and rule.absent is not None:
            columns[rule.column] = rule.missing()
    if participant is not None:
        value = participant if isinstance(participant, Column) else F.lit(participant)
        columns[PARTICIPANT] = value.cast("string")
    columns[LOAD_STAMP] = load_stamp(as_of)
    return df.select(*[column.alias(name) for name, column in columns.items()])


def _attach_presence(df, has, input_id, broadcast_bytes) -> DataFrame:
    """Add, per row, which marked columns its input has any value in."""
    seen = [F.bool_or(F.col(quoted(c)).isNotNull()).alias(flag) for c, flag in has.items()]
    inputs = materialize(
        df.groupBy(input_id).agg(F.count(F.lit(1)).alias("n_rows"), *seen), "inputs"
    )
    lacks_one = functools.reduce(operator.or_, [~F.col(flag) for flag in has.values()])
    return attach(df, inputs, input_id, lacks_one, broadcast_bytes=broadcast_bytes)
