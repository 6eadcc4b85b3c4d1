"""Records as VARIANT: text is read once, and its keys and schema are found in what was read.

Two ways to a schema, both aggregates over stored records: ``infer_schemas``
merges the schema of each record per group of files; ``key_census`` counts every
key path with its types, so that keys no schema declares are seen and can be
declared. Both widen by one rule:

* null takes the type of the other values, and is text where there are none;
* whole numbers are ``bigint``; with any other number, or a fraction, ``double``;
  whole numbers of more than 20 digits are ``decimal``;
* kinds that do not go together (a text and a number, an object and a list) are
  text: the JSON of the value, numbers without trailing zeros;
* objects take the keys of both, lists the wider entry; an object that never has
  a key is left out, a list that never has an entry is a list of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.session import materialize
from recordlake.sources.ndjson import BAD, FILLED, judge_lines, read_lines

RECORD = "_record"
ENTRY = None  # in a path: any entry of a list

OBJECT, ARRAY, NULL = "OBJECT", "ARRAY", "VOID"
WHOLE, NUMBERS = "BIGINT", {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}
LONG_DIGITS = 20
# a kind is a type without its inner part, but for whole numbers of more digits than that
KIND = r"^DECIMAL\((?:2[1-9]|3[0-9]),0\)|^[A-Z]+"


def read_records(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """One row per line: the record as VARIANT beside the levels of its path and its verdict.

    The text is scanned once, parsed and stored; what asks for schemas, keys,
    verdicts (``audit_files``) or columns reads the stored rows. A bad or blank
    line has a null record.
    """
    lines = judge_lines(read_lines(spark, paths, **options), as_variant=True)
    good = F.when(F.col(FILLED) & ~F.col(BAD), F.col("value"))
    others = [quoted(c) for c in lines.columns if c != "value"]
    return materialize(lines.select(*others, F.try_parse_json(good).alias(RECORD)), "records")


def infer_schemas(records: DataFrame, keys: Sequence[str]) -> dict[tuple, T.StructType]:
    """The schema of the records of each combination of ``keys``, as one aggregate.

    It is merged in each task before the shuffle: one row per group and task
    moves, however many records there are. A group without records has none.
    """
    shapes = records.groupBy(*keys).agg(F.schema_of_variant_agg(RECORD).alias("_shape"))
    found = {}
    for row in shapes.collect():  # one row per source, version and type
        schema = widened(_parsed(row["_shape"]))
        if isinstance(schema, T.StructType):
            found[tuple(row[k] for k in keys)] = schema
    return found


# names may be in backticks; a type that stands where a name does is followed by a colon
_WORDS = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bVOID\b(?!:)")
_DDL = {"OBJECT": "STRUCT", "VOID": "VOID"}


def _parsed(shape: str) -> T.DataType:
    ddl = _WORDS.sub(lambda m: _DDL.get(m[0], m[0]), shape)
    return T._parse_datatype_string(ddl)


def widened(found: T.DataType) -> T.DataType | None:
    """A type as the rule has it; None for an object without keys."""
    if isinstance(found, T.StructType):
        fields = [(f.name, widened(f.dataType)) for f in found.fields]
        kept = [T.StructField(name, t) for name, t in fields if t is not None]
        return T.StructType(kept) if kept else None
    if isinstance(found, T.ArrayType):
        return T.ArrayType(widened(found.elementType) or T.StringType())
    if isinstance(found, T.DecimalType):
        long = found.scale == 0 and found.precision > LONG_DIGITS
        return found if long else T.DoubleType()
    if isinstance(found, (T.NullType, T.VariantType)):
        return T.StringType()
    return T.DoubleType() if isinstance(found, T.FloatType) else found


def key_census(records: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How often each key path occurs with each type: ``keys, path, type, n``.

    ``path`` lists the keys from the record down, null for the entries of a
    list; types are those of VARIANT without their inner part, such as
    ``OBJECT`` or ``DECIMAL`` (whole numbers of more than 20 digits keep theirs). Values are opened level by level, and each level
    is counted before the shuffle, so what moves is one row per task, path and
    type. It ends at the deepest record.
    """
    named = [F.col(quoted(k)) for k in keys]
    # a container's inner types, which would be found again at each level, are not looked for
    as_object = F.try_variant_get("value", "$", "map<string,variant>")
    as_list = F.try_variant_get("value", "$", "array<variant>")
    found = F.when(as_object.isNotNull(), OBJECT).when(as_list.isNotNull(), ARRAY)
    found = found.otherwise(F.schema_of_variant("value"))
    values = records.where(F.col(RECORD).isNotNull()).select(
        *named, F.array().cast("array<string>").alias("path"), F.col(RECORD).alias("value")
    )
    explode, levels = records.sparkSession.tvf.variant_explode, []
    while True:
        opened = values.withColumnRenamed("value", "_held").lateralJoin(
            explode(F.col("_held").outer())
        )
        # what has no content, or is none of both, gives no row
        values = opened.select(
            *named,
            F.concat("path", F.array("key")).alias("path"),
            F.coalesce("value", F.parse_json(F.lit("null"))).alias("value"),
        )
        counted = (
            values.groupBy(*named, "path", found.alias("type"))
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*named, "path", F.regexp_extract("type", KIND, 0).alias("type"))
            .agg(F.sum("n").alias("n"))
        )
        levels.append(materialize(counted, "key-census"))
        if not levels[-1].where(F.col("type").isin(OBJECT, ARRAY)).take(1):
            break
    census = levels[0]
    for level in levels[1:]:
        census = census.unionByName(level)
    return census


def schema_of_census(rows: Iterable[Row]) -> T.StructType:
    """The schema that counted paths and types make: one row per path and type, any order."""
    types: dict[tuple, set[str]] = {}
    for row in rows:
        types.setdefault(tuple(row["path"]), set()).add(row["type"])
    children: dict[tuple, list] = {}
    for path in sorted(types, key=lambda p: [(k is not None, k or "") for k in p]):
        children.setdefault(path[:-1], []).append(path)

    def type_of(path: tuple) -> T.DataType | None:
        kinds = types[path] - {NULL}
        if kinds == {OBJECT}:
            return object_of(path)
        if kinds == {ARRAY}:
            entries = children.get(path, [])
            return T.ArrayType((type_of(entries[0]) if entries else None) or T.StringType())
        long = {k for k in kinds if k.startswith("DECIMAL(")}
        if long and kinds - long <= {WHOLE}:
            return max((T._parse_datatype_string(k) for k in long), key=lambda t: t.precision)
        if kinds and kinds - long <= NUMBERS:
            return T.LongType() if kinds == {WHOLE} else T.DoubleType()
        return T.BooleanType() if kinds == {"BOOLEAN"} else T.StringType()

    def object_of(path: tuple) -> T.StructType | None:
        fields = [(p[-1], type_of(p)) for p in children.get(path, [])]
        kept = [T.StructField(name, t) for name, t in fields if t is not None]
        return T.StructType(kept) if kept else None

    return object_of(()) or T.StructType([])


def undeclared(census: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a census whose path the schema does not declare.

    The declared paths are as many as the schema has names; they are broadcast.
    """
    spark = census.sparkSession
    known = [(list(path),) for path in _paths(schema, ())]
    declared = spark.createDataFrame(known, "path array<string>")
    # arrays with nulls are equal place by place, as text that tells null apart
    same = F.to_json(F.struct(census["path"])) == F.to_json(F.struct(declared["path"]))
    return census.join(F.broadcast(declared), same, "left_anti")


def _paths(found: T.DataType, path: tuple):
    if path:
        yield path
    if isinstance(found, T.StructType):
        for field in found.fields:
            yield from _paths(field.dataType, (*path, field.name))
    elif isinstance(found, T.ArrayType):
        yield from _paths(found.elementType, (*path, ENTRY))


def merged(declared: T.DataType, found: T.DataType) -> T.DataType:
    """The declared type with what was found beside it; where both have a name, declared wins."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        own = {f.name: f for f in found.fields}
        fields = [
            T.StructField(f.name, merged(f.dataType, own[f.name].dataType)) if f.name in own else f
            for f in declared.fields
        ]
        return T.StructType(fields + [f for f in found.fields if f.name not in declared.names])
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged(declared.elementType, found.elementType))
    return declared


def ddl(found: T.DataType) -> str:
    """A type as text, names quoted at every level."""
    if isinstance(found, T.StructType):
        inner = ", ".join(f"{quoted(f.name)}: {ddl(f.dataType)}" for f in found.fields)
        return f"struct<{inner}>"
    if isinstance(found, T.ArrayType):
        return f"array<{ddl(found.elementType)}>"
    return found.simpleString()


def with_columns(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The records' fields as columns beside the others; a value of another type is null.

    Rows without a record (bad and blank lines) go.
    """
    others = [quoted(c) for c in records.columns if c not in (RECORD, *schema.names)]
    fields = F.try_variant_get(RECORD, "$", ddl(schema))
    return records.where(F.col(RECORD).isNotNull()).select(
        *others, F.inline_outer(F.array(fields))
    )
