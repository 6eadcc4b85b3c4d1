"""Run a plain per-row function over chosen columns of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


ROWS = 128  # taken from an Arrow batch at once, so that few texts are unpacked at a time


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names clash with ``names``, in any case."""
    clash = {n.casefold() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.casefold() not in clash])


def annotate(
    df: DataFrame,
    make: Callable[[], Callable[..., tuple]],
    fields: dict[str, str],
    reads: list[str],
    keep: list[str] | None = None,
    batched: bool = False,
) -> DataFrame:
    """Add ``fields`` (name to type) computed from the columns ``reads``.

    ``make`` runs once per task and returns the row function: column values
    in, one tuple in the order of ``fields`` out; if ``batched``, it takes lists
    of some rows' values and gives a list of tuples. ``keep`` lists the input
    columns to carry along (all of them if None); a kept column whose name
    equals a new field in any case is replaced by it. Rows stream through a few
    at a time, so memory is one Arrow batch, whatever the partition holds.
    """
    clash = {n.casefold() for n in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.casefold() not in clash]
    # inputs travel under names of their own, so that no kept name can clash with them
    sent = df.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(reads)],
    )
    schema = T.StructType(
        [sent.schema[c] for c in kept]
        + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]
    )
    n_kept, n_reads = len(kept), len(reads)
    names, types = [*kept, *fields], [ARROW[t] for t in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in pieces_of(batches):
            values = [batch.column(n_kept + i).to_pylist() for i in range(n_reads)]
            results = row(*values) if batched else [row(*v) for v in zip(*values)]
            columns = list(zip(*results)) if results else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_kept)]
                + [pa.array(list(c), type=t) for c, t in zip(columns, types)],
                names=names,
            )

    return sent.mapInArrow(run, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    from recordlake.session import materialize

    return materialize(df, label)
