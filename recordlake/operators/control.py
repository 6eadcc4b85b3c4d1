"""Control rows: what was exported, what is routed where, what is skipped."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.functions.names import quoted

SKIP = "skip"
PROCEED = "proceed"


def flatten_manifest(exports: DataFrame, keys: list[str], order: str, *, keep: str = "last") -> DataFrame:
    """Files of export manifests: ``keys, type, url``.

    ``exports`` has one row per manifest, ``output array<struct<type,url>>``
    and ``order``, by which later manifests replace earlier ones. With
    ``keep="last"`` the last entry of a type wins; it is found by a partial
    aggregate, so a frequent type never gathers in one task. ``keep="all"``
    returns every entry.
    """
    if keep not in ("last", "all"):
        raise ValueError(f"keep must be 'last' or 'all', not {keep!r}")
    entries = exports.select(
        *keys, order, F.posexplode("output").alias("_position", "_entry")
    ).select(*keys, order, "_position", "_entry.type", "_entry.url")
    if keep == "all":
        return entries.select(*keys, "type", "url")
    return entries.groupBy(*keys, "type").agg(
        F.max_by("url", F.struct(order, "_position")).alias("url")
    )


def route(control: DataFrame, known: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Set ``status``: ``proceed`` where (source, version, model) is in ``known``, else ``skip``.

    ``known`` is what transformations exist, a short list. A row already marked
    ``skip`` stays so; a null in any of the three is known to no transformation.
    """
    keys = ["source", "version", "model"]
    rows = sorted({(*triple, True) for triple in known})
    schema = "source string, version string, model string, _known boolean"
    joined = control.join(F.broadcast(control.sparkSession.createDataFrame(rows, schema)), keys, "left")
    proceed = F.col("_known").eqNullSafe(F.lit(True))
    if "status" in control.columns:
        proceed &= ~F.col("status").eqNullSafe(F.lit(SKIP))
    others = [F.col(quoted(c)) for c in control.columns if c != "status"]
    return joined.select(*others, F.when(proceed, PROCEED).otherwise(SKIP).alias("status"))


def active(control: DataFrame) -> DataFrame:
    """All rows but those marked ``skip``; a row without a status stays."""
    return control.where(~F.col("status").eqNullSafe(F.lit(SKIP)))
