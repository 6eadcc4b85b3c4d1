"""Attach a per-key fact to every row without a skewed shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 1000
SPREAD = 64


def attach(
    df: DataFrame,
    keys: DataFrame,
    key: str,
    needed: Column,
    *,
    rows: str = "n_rows",
    broadcast_bytes: int = BROADCAST_BYTES,
    spread: int = SPREAD,
) -> DataFrame:
    """Left-join the other columns of ``keys`` to ``df`` on ``key``.

    ``keys`` has one row per key value of ``df`` with the number of rows it
    stands for; read it from a written table, since it is scanned up to four
    times. Only rows matching ``needed`` carry a fact, so only they are
    joined; every other row of ``df`` gets nulls. A null
    key is a key like others.

    Where no row is needed nothing is joined. The needed rows are broadcast when their measured size fits. Beyond that
    they are shuffle-joined, except for hot keys: a key holding more than
    1/1000 of all rows is one of fewer than 1000, so those are broadcast
    whatever their kind, and their rows of ``df`` are spread over ``spread``
    partitions of the shuffle instead of meeting in one.
    """
    facts = [c for c in keys.columns if c not in (key, rows)]
    wanted = keys.where(needed)
    size = wanted.agg(
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(key, *facts)))), F.lit(0))
    ).first()[0]
    if size == 0:
        none = [F.lit(None).cast(keys.schema[c].dataType).alias(c) for c in facts]
        return df.select(*[F.col(f"`{c}`") for c in df.columns], *none)
    same = F.col(key).eqNullSafe(F.col("_key"))
    if size <= broadcast_bytes:
        small = wanted.select(F.col(key).alias("_key"), *facts)
        joined = df.join(F.broadcast(small), same, "left")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], *facts)

    total = keys.agg(F.sum(rows)).first()[0]
    is_hot = F.col(rows) * HOT_SHARE > F.lit(total)
    fact = F.struct(*facts)
    hot = keys.where(is_hot).select(
        F.col(key).alias("_key"), F.lit(True).alias("_is_hot"), F.when(needed, fact).alias("_hot")
    )
    cold = keys.where(needed & ~is_hot).select(
        F.col(key).alias("_cold_key"), F.lit(0).cast("bigint").alias("_cold_slot"), fact.alias("_cold")
    )
    # the slot follows from row values, so a recomputed task repeats it
    plain = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))
    ]
    slot = F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*plain), F.lit(spread)) + 1).otherwise(0)
    joined = (
        df.join(F.broadcast(hot), same, "left")
        .withColumn("_slot", slot.cast("bigint"))
        .join(
            cold,
            F.col(key).eqNullSafe(F.col("_cold_key")) & (F.col("_slot") == F.col("_cold_slot")),
            "left",
        )
        .withColumn("_fact", F.coalesce("_hot", "_cold"))
    )
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], "_fact.*")
