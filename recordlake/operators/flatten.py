"""Flatten nested records into one row of snake_case columns.

The schema is walked once on the driver and turned into a single ``select`` of
built-in expressions, so nested fields prune down to the scan and no row ever
passes through Python.

Rules:

* nested objects become ``parent__child`` columns;
* a list of objects becomes one list per key, without the entries whose key is
  absent (``aligned=True`` keeps a null in their place);
* nothing below a list is flattened further: inner objects and lists stay
  nested and keep their raw key names;
* empty lists and empty objects become null.

A parsed record no longer tells a null that was written out from a key that
was absent: both are dropped from such a list. Where the text of the record is
at hand, ``text`` keeps the written nulls as entries.
"""

from __future__ import annotations

import functools
import operator
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted, snake_case


_WRITTEN, _LISTS = "_written_record", "_written_lists"


@dataclass(frozen=True)
class Leaf:
    """One output column before name collisions are settled."""

    name: str
    path: tuple[str, ...]
    value: Column
    data_type: T.DataType

    @property
    def source(self) -> str:
        return ".".join(self.path)


def flatten(
    df: DataFrame,
    sep: str = "__",
    *,
    aligned: bool = False,
    on_collision: str = "error",
    null_elements: str = "keep",
    text: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Flatten every column of ``df``; output columns are sorted by name.

    Two raw keys can end in one name (``Id`` and ``id``). ``on_collision``
    is ``"error"``, or ``"coalesce"``: the later key in schema order wins
    where it is present, and keys of one list of objects are all appended. With
    ``"last"``, which needs ``text``, the key that the record's own text has
    last wins, even by a null; keys of one list are appended as before. A key
    with a quote ``'`` in its name cannot be placed in a text and is an error.

    A list holding nulls among its objects is not a list of objects: it stays
    whole under its own name and yields no per-key lists. With
    ``null_elements="skip"`` the nulls are ignored instead; where lists are known
    to hold none, that lets a scan read single fields of their objects.

    ``text`` names the column with each record's JSON text. It is not part of
    the output; nulls written out in it stay in the per-key lists. A text that
    cannot be read as a whole, such as one beyond the size of a VARIANT, fails
    the job rather than losing them. ``carry`` names columns that are no part of
    the record; they come first, as they are, and should start with ``_``, which
    no flattened name does.
    """
    if on_collision not in ("error", "coalesce", "last"):
        raise ValueError(f"on_collision must be 'error', 'coalesce' or 'last', not {on_collision!r}")
    if on_collision == "last" and text is None:
        raise ValueError("on_collision='last' needs the records' text")
    if null_elements not in ("skip", "keep"):
        raise ValueError(f"null_elements must be 'skip' or 'keep', not {null_elements!r}")

    written = None
    schema = T.StructType([f for f in df.schema.fields if f.name not in (text, *carry)])
    if text is not None:
        df = df.withColumn(_WRITTEN, F.parse_json(F.col(quoted(text))))
        written = F.col(_WRITTEN)
    walk = _Walk(sep, aligned, null_elements, written, [])
    leaves: dict[str, list[Leaf]] = defaultdict(list)
    for leaf in walk.object_leaves(schema, (), ""):
        leaves[leaf.name].append(leaf)

    if walk.lists:
        df = df.withColumn(_LISTS, F.struct(*walk.lists))
    clashes = {n: [leaf.source for leaf in found] for n, found in leaves.items() if len(found) > 1}
    if clashes and on_collision == "error":
        raise ValueError(f"raw keys share a column name: {clashes}")
    carried = [F.col(quoted(c)) for c in carry]
    order = F.col(quoted(text)) if on_collision == "last" else None
    return df.select(*carried, *[_settle(name, leaves[name], order) for name in sorted(leaves)])


@dataclass(frozen=True)
class _Walk:
    sep: str
    aligned: bool
    null_elements: str
    written: Column | None
    lists: list[Column]  # of the text, each with its objects' fields, as they are met

    def object_leaves(self, struct, path, prefix) -> Iterator[Leaf]:
        for field in struct.fields:
            raw = (*path, field.name)
            name = prefix + snake_case(field.name)
            column = F.col(quoted(*raw))
            if isinstance(field.dataType, T.StructType):
                yield from self.object_leaves(field.dataType, raw, name + self.sep)
            elif not isinstance(field.dataType, T.ArrayType):
                yield Leaf(name, raw, column, field.dataType)
            elif isinstance(field.dataType.elementType, T.StructType):
                yield from self.list_leaves(field.dataType, raw, name)
            else:
                filled = F.when(F.size(column) > 0, column)
                yield Leaf(name, raw, filled, field.dataType)

    def list_leaves(self, list_type, raw, name) -> Iterator[Leaf]:
        items = F.col(quoted(*raw))
        has_null = F.exists(items, lambda item: item.isNull())
        if self.null_elements == "keep":
            yield Leaf(name, raw, F.when(has_null, items), list_type)

        keys: dict[str, list[T.StructField]] = defaultdict(list)
        for field in list_type.elementType.fields:
            keys[snake_case(field.name)].append(field)
        typed = None
        if self.written is not None and not self.aligned:
            typed = F.col(_LISTS)[f"l{len(self.lists)}"]
            self.lists.append(_written_list(self.written, raw, list_type).alias(f"l{len(self.lists)}"))
        for key, fields in keys.items():
            if len({f.dataType for f in fields}) > 1:
                raise ValueError(f"raw keys of {'.'.join(raw)} share {key!r} but not a type")
            found = self.values(items, raw, fields, typed)
            if self.null_elements == "keep":
                found = F.when(~F.coalesce(has_null, F.lit(False)), found)
            leaf_type = T.ArrayType(fields[0].dataType)
            # raw keys of one element append: they are one leaf, but still a clash
            yield Leaf(name + self.sep + key, (*raw, fields[0].name), found, leaf_type)
            for extra in fields[1:]:
                yield Leaf(name + self.sep + key, (*raw, extra.name), None, leaf_type)

    def values(self, items, raw, fields, typed) -> Column:
        parsed = _values_of(items, fields)
        if self.aligned:
            return F.when(F.size(items) > 0, parsed)
        found = F.when(
            F.exists(parsed, lambda v: v.isNotNull()), F.filter(parsed, lambda v: v.isNotNull())
        )
        if self.written is None:
            return found
        kept = _written_values(self.written, raw, fields)
        if len(fields) == 1:
            # only where a value is null does it matter whether its key is there
            values = typed.getField(fields[0].name)
            kept = F.when(F.forall(values, lambda v: v.isNotNull()), values).otherwise(kept)
        # in a list of one, so that it is made once
        filled = F.get(F.filter(F.array(kept), lambda v: F.size(v) > 0), F.lit(0))
        return F.when(self.written.isNull(), found).otherwise(filled)


def _values_of(items: Column, fields: list[T.StructField]) -> Column:
    if len(fields) == 1:
        return items.getField(fields[0].name)
    return F.flatten(
        F.transform(
            items,
            lambda item: F.filter(
                F.array(*[item.getField(f.name) for f in fields]), lambda v: v.isNotNull()
            ),
        )
    )


def _written_list(record: Column, raw, list_type: T.ArrayType) -> Column:
    """The list of objects in a record's text; a key that is absent is null, as a written null is."""
    fields = [f"{quoted(f.name)}: {f.dataType.simpleString()}" for f in list_type.elementType.fields]
    return F.try_variant_get(record, _json_path(*raw), f"array<struct<{', '.join(fields)}>>")


def _written_values(record: Column, raw, fields: list[T.StructField]) -> Column:
    """The values of the keys that are there, written nulls included."""
    items = F.try_variant_get(record, _json_path(*raw), "array<variant>")
    per_item = F.transform(
        items,
        lambda item: F.filter(
            F.array(*[F.try_variant_get(item, _json_path(f.name), "variant") for f in fields]),
            lambda v: v.isNotNull(),
        ),
    )
    to_type = fields[0].dataType.simpleString()
    return F.transform(F.flatten(per_item), lambda v: F.try_variant_get(v, "$", to_type))


def _json_path(*keys: str) -> str:
    quotes = ["'" if '"' in key else '"' for key in keys]
    return "$" + "".join(f"[{quote}{key}{quote}]" for key, quote in zip(keys, quotes))


def _place(record: Column, path: tuple[str, ...]) -> Column:
    """Where a key stands in a record's text, level by level; null if it does not."""
    if any("'" in key for key in path):
        raise ValueError(f"cannot place {path} in a text: its name has a quote")
    steps = []
    for depth, key in enumerate(path):
        above = "".join(f"['{k}']" for k in path[:depth])
        held = F.get_json_object(record, f"${above}") if depth else record
        steps.append(F.array_position(F.json_object_keys(held), key))
    there = [F.coalesce(step, F.lit(0)) > 0 for step in steps]
    return F.when(functools.reduce(operator.and_, there), F.array(*steps))


def _settle(name: str, found: list[Leaf], record: Column | None = None) -> Column:
    values = [leaf for leaf in found if leaf.value is not None]
    if len(values) == 1:
        return values[0].value.alias(name)
    if len({leaf.data_type for leaf in values}) > 1:
        raise ValueError(f"raw keys {[leaf.source for leaf in values]} share {name!r} but not a type")
    if record is None:
        return F.coalesce(*[leaf.value for leaf in reversed(values)]).alias(name)
    places = [_place(record, leaf.path) for leaf in values]
    last = F.greatest(*places)  # skips what is not there
    chosen = F.lit(None)
    for leaf, place in zip(values, places):
        chosen = F.when(place == last, leaf.value).otherwise(chosen)
    return chosen.alias(name)
