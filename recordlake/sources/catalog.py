"""Tables in the session's catalog, with their partitions recorded there.

A path is listed whole before any directory is pruned. A table whose partitions
the catalog knows is asked for the levels a filter wants, and only those
directories are listed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.sources.layout import LOADED_LEVELS
from recordlake.sources.registry import parse_schema, to_ddl


def define_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str] = LOADED_LEVELS,
) -> None:
    """An external Parquet table below ``path``; one that exists stays as it is.

    Levels that ``schema`` lacks are added as text. No file is read and no
    partition known yet: ``store`` records those it writes, ``adopt`` those
    that are there already.
    """
    own = [field for field in schema.fields if field.name not in partition_by]
    types = {field.name: field.dataType for field in schema.fields}
    levels = [T.StructField(level, types.get(level, T.StringType())) for level in partition_by]
    levelled = ", ".join(quoted(level) for level in partition_by)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({to_ddl(T.StructType(own + levels))}) "
        f"USING parquet PARTITIONED BY ({levelled}) LOCATION '{place}'"
    )


def define_tables(
    spark: SparkSession, schemas: DataFrame, names: Mapping[str, str], root: str
) -> list[str]:
    """A table for each registered schema whose ``model`` has a name in ``names``.

    Each lies in the folder of its model below ``root``; the names are returned.
    Two schemas of one model (of two sources, say) raise: filter them first.
    """
    # one row a record type that the caller names
    rows = schemas.where(F.col("model").isin(*names)).select("model", "schema_json").collect()
    models = [row["model"] for row in rows]
    if len(set(models)) < len(models):
        raise LookupError(f"several schemas of one model: {sorted(models)}")
    for model, schema_json in rows:
        define_table(spark, names[model], parse_schema(schema_json), f"{root}/{model}")
    return [names[model] for model in models]


def store(df: DataFrame, name: str, *, rebalance: bool = False) -> None:
    """Write into a table by column name; partitions that ``df`` holds are replaced.

    The write itself records new partitions. ``rebalance`` is that of
    ``write_table``. Columns the table lacks raise, columns ``df`` lacks are null.
    """
    table = df.sparkSession.table(name)
    unknown = sorted(set(df.columns) - set(table.columns))
    if unknown:
        raise ValueError(f"{name} has no columns {unknown}")
    columns = [
        (F.col(quoted(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
    ]
    rows = df.select(*columns)
    if rebalance:
        rows = rows.hint("rebalance", *_levels(df.sparkSession, name))
    rows.write.insertInto(name, overwrite=True)


def adopt(spark: SparkSession, name: str) -> None:
    """Record the partitions of files that something else wrote: one listing, here and not in reads."""
    spark.catalog.recoverPartitions(name)


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """One row per recorded partition, a text column per level; no directory is listed."""
    recorded = spark.sql(f"SHOW PARTITIONS {name}")
    parts = F.split("partition", "/")
    # a level is written as name=value, with reserved characters as %XX
    values = [
        F.regexp_replace(F.get(parts, F.lit(i)), "^[^=]*=", "") for i in range(len(_levels(spark, name)))
    ]
    decoded = [F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))) for value in values]
    return recorded.select(*[v.alias(level) for v, level in zip(decoded, _levels(spark, name))])


def read_levels(spark: SparkSession, name: str, **levels: str | Sequence[str]) -> DataFrame:
    """The rows at the given levels, each one value or several; other directories are not listed."""
    known = _levels(spark, name)
    odd = sorted(set(levels) - set(known))
    if odd:
        raise ValueError(f"{name} has no levels {odd}, only {known}")
    df = spark.table(name)
    for level, wanted in levels.items():
        df = df.where(F.col(quoted(level)).isin(*([wanted] if isinstance(wanted, str) else wanted)))
    return df


def _levels(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
