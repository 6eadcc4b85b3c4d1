"""Flatten nested records into scalar columns by exploding every list."""

from __future__ import annotations

import functools
import logging
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted

logger = logging.getLogger(__name__)


@dataclass
class _Plan:
    """What a schema asks for: lists to open, in order, and the scalars to keep."""

    sep: str
    rename: Callable[[str], str]
    lists: dict[str, tuple[str, str]] = field(default_factory=dict)  # slot: (name, path)
    scalars: list[tuple[str, str]] = field(default_factory=list)  # (name, path)
    siblings: bool = False

    def visit(self, name: str, path: tuple[str, ...], kind: T.DataType, above: int) -> None:
        """``above``: how many lists stand around this value."""
        if isinstance(kind, T.ArrayType):
            self.siblings |= len(self.lists) > above
            slot = f"_open{len(self.lists)}"
            self.lists[slot] = (name, quoted(*path))
            self.visit(name, (slot,), kind.elementType, above + 1)
        elif isinstance(kind, T.StructType):
            for child in kind.fields:
                child_name = self.rename(name + self.sep + child.name)
                self.visit(child_name, (*path, child.name), child.dataType, above)
        else:
            self.scalars.append((self.rename(name), quoted(*path)))


def explode_flatten(
    df: DataFrame,
    sep: str = "_",
    *,
    rename: Callable[[str], str] = str,
    prefix: str = "",
) -> DataFrame:
    """One row per combination of list elements, until only scalars are left.

    The schema alone says which lists there are: each becomes one generator,
    outer lists before those in them (an empty or null list keeps its row), and
    one projection names every scalar ``rename(parent + sep + child)``. Lists
    that are siblings in one record multiply, which is the operator's meaning:
    a warning names them, since dropping the columns afterwards does not undo
    it. ``prefix`` is put before every name once. Records that are already flat
    come back unchanged.
    """
    plan = _Plan(sep, rename)
    for top in df.schema.fields:
        plan.visit(top.name, (top.name,), top.dataType, 0)
    if len(plan.scalars) == len(df.columns) and not plan.lists and not _nested(df):
        return df
    if plan.siblings:
        names = [name for name, _ in plan.lists.values()]
        logger.warning("sibling lists multiply the rows of a record: %s", names)
    clashes = [n for n, count in Counter(name for name, _ in plan.scalars).items() if count > 1]
    if clashes:
        raise ValueError(f"raw keys share a column name: {clashes}")
    opened = functools.reduce(
        lambda rows, item: rows.select("*", F.explode_outer(item[1][1]).alias(item[0])),
        plan.lists.items(),
        df,
    )
    return opened.select(*[F.col(path).alias(prefix + name) for name, path in plan.scalars])


def _nested(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, T.StructType) for f in df.schema.fields)
