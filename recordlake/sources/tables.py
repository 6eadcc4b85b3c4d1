"""Parquet in and out, gzip NDJSON out, and NDJSON to Parquet in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.sources.layout import LOADED_LEVELS, lineage
from recordlake.sources.ndjson import ORIGIN, SOURCE_FILE, read_ndjson
from recordlake.sources.variants import with_columns

SMALL_SCAN = 8
# the default level takes twice the time to write a file smaller by a third
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def read_tables(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Parquet of all ``paths`` in one scan.

    Columns that only some files have are null elsewhere. Declare ``schema``
    when files disagree on a type, or to skip reading every footer.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**options)
    reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
    return reader.parquet(*paths)


def spread(df: DataFrame) -> DataFrame:
    """Use more cores on an input too small to be split: one file, one row group.

    Only a scan with fewer than ``SMALL_SCAN`` tasks is dealt out, about 1 GB at
    the usual split size; anything larger is never shuffled here, however many
    cores there are.
    """
    wanted = min(SMALL_SCAN, df.sparkSession.sparkContext.defaultParallelism)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    mode: str = "overwrite",
    rebalance: bool = False,
) -> None:
    """Write Parquet; an overwrite replaces only the partitions ``df`` holds.

    ``rebalance`` shuffles rows by partition first, so that each directory gets
    few files of the advised size; adaptive execution splits large partitions
    over several tasks. Without it every task writes into every partition it
    meets: no shuffle, more files. ``path`` must not be one that ``df`` reads:
    an overwrite deletes old files before their rows are read.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    elif rebalance:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_ndjson(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    mode: str = "overwrite",
    records_per_file: int = 0,
) -> None:
    """Write gzip NDJSON. Gzip cannot be split, so bound what one file holds."""
    writer = df.write.mode(mode).option("compression", "gzip")
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def paired(inputs: str | Sequence[str], outputs: str | Sequence[str]) -> list[tuple[str, str]]:
    """Match inputs to outputs, given as lists or comma-separated text."""
    inputs = inputs.split(",") if isinstance(inputs, str) else list(inputs)
    outputs = outputs.split(",") if isinstance(outputs, str) else list(outputs)
    if len(inputs) != len(outputs):
        raise ValueError(f"{len(inputs)} input paths but {len(outputs)} output paths")
    return list(zip(inputs, outputs))


def load_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """What ``load_ndjson`` gives, from records that ``variants.read_records`` has stored.

    The schema is one that ``infer_schemas`` found in those same records, so
    the text is not read again. The records come from the landing layout, whose
    levels they have as columns.
    """
    named = records.drop(*ORIGIN).withColumnRenamed("model", "resource_type")
    loaded = with_columns(named, schema)
    return loaded.select(*[quoted(c) for c in schema.names], *[c for c in LOADED_LEVELS if c not in schema.names])


def load_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Records of many files with the loaded layout's columns, from their paths.

    Write it with ``write_table(..., LOADED_LEVELS)``: one job in place of one
    read and one write per file. Level columns the records or the directories
    already provide are kept.
    """
    df = read_ndjson(spark, paths, schema, **options)
    known = lineage()
    known["resource_type"] = known.pop("model")
    added = [known[c].alias(c) for c in LOADED_LEVELS if c not in df.columns]
    kept = [quoted(c) for c in df.columns if c != SOURCE_FILE]
    return df.select(*kept, *added)
