"""Schemas of record types, kept as Spark schema JSON beside the data."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted

KEYS = ("source", "version", "model")

# ---- Fixed value: how a schema file without directory levels is named. ----
SCHEMA_SUFFIX = "_schema.json"

_FIELDS = T.StructType(
    [
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("nullable", T.BooleanType()),
                    ]
                )
            ),
        )
    ]
)


def write_schemas(
    spark: SparkSession, root: str, schemas: Mapping[tuple[str, str, str], T.StructType]
) -> None:
    """Store schemas by (source, version, model); others already there stay.

    Pass the schema a load has already inferred: no second scan is needed.
    """
    rows = [(*key, schema.json()) for key, schema in schemas.items()]
    entries = spark.createDataFrame(rows, "source string, version string, model string, value string")
    entries.coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*KEYS).text(root)


def read_schemas(spark: SparkSession, root: str) -> DataFrame:
    """``source, version, model, schema_json``: all schemas below ``root``."""
    texts = spark.read.text(root, wholetext=True)
    levels = [F.col(k) for k in KEYS if k in texts.columns]
    if len(levels) != len(KEYS):
        raise ValueError(f"{root} has no {KEYS} directories; use read_schema_files")
    return texts.select(*levels, F.trim(F.translate("value", "\n", " ")).alias("schema_json"))


def read_schema_files(spark: SparkSession, root: str) -> DataFrame:
    """``model, schema_json`` from files named ``<model>_schema.json``; others are skipped."""
    name = F.col("_metadata.file_name")
    texts = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    model = F.regexp_replace(name, SCHEMA_SUFFIX + "$", "")
    return texts.where(name.endswith(SCHEMA_SUFFIX)).select(
        model.alias("model"), F.col("value").alias("schema_json")
    )


def write_schema_files(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]
) -> None:
    """Store schemas as ``<model>_schema.json`` below ``root``, for ``read_schema_files``.

    Spark names its own part files, so these few small files go through the
    file system that holds ``root``.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for model, schema in schemas.items():
        path = hadoop.Path(f"{root}/{model}{SCHEMA_SUFFIX}")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()


def table_definitions(schemas: DataFrame) -> DataFrame:
    """One row per column of each schema; a nested type comes as JSON text."""
    keys = [c for c in schemas.columns if c != "schema_json"]
    fields = F.from_json("schema_json", _FIELDS)["fields"]
    return schemas.select(*keys, F.posexplode(fields).alias("position", "field")).select(
        *keys,
        "position",
        F.col("field.name").alias("column"),
        F.col("field.type").alias("type"),
        F.col("field.nullable").alias("nullable"),
    )


def schema_of(schemas: DataFrame, model: str, **keys: str) -> T.StructType:
    """The stored schema of one record type, to declare in a read."""
    found = schemas.where(F.col("model") == model)
    for key, value in keys.items():
        found = found.where(F.col(key) == value)
    rows = found.select("schema_json").take(2)
    if len(rows) != 1:
        raise LookupError(f"{len(rows) or 'no'} schemas for {model} {keys or ''}")
    return parse_schema(rows[0][0])


def parse_schema(schema_json: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema_json))


def to_ddl(schema: T.StructType) -> str:
    """The schema as column DDL, to create a table with; names are quoted at every depth."""
    return ", ".join(f"{quoted(f.name)} {_ddl_type(f.dataType)}" for f in schema.fields)


def _ddl_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StructType):
        fields = [f"{quoted(f.name)}: {_ddl_type(f.dataType)}" for f in data_type.fields]
        return f"struct<{', '.join(fields)}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{_ddl_type(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{_ddl_type(data_type.keyType)}, {_ddl_type(data_type.valueType)}>"
    return data_type.simpleString()
