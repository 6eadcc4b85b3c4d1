"""Newline-delimited JSON: scans, and rejection of whole bad files.

One line that is not a JSON object rejects the file it is in. Text is split, so
no file, however large, has to pass through one task. ``parse_and_judge`` reads
it once: store what it gives, audit the narrow columns, filter the rest by file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.operators.keyed import BROADCAST_BYTES, attach
from recordlake.session import materialize

SOURCE_FILE = "_source_file"
BLOCK = "_source_block"
FILLED, BAD, POSITION = "_line_filled", "_line_bad", "_line_position"
ORIGIN = (SOURCE_FILE, BLOCK, FILLED, BAD, POSITION)
# judge and parse use one map, so that no line passes the one and fails the other;
# the parser's own limits on texts, numbers and nesting would make nulls of records
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": "100000",
}

# a text of fewer bytes always fits: VARIANT holds 16 MiB in the oldest version that has it,
# and a value takes at most a few times the bytes of its text
VARIANT_SAFE_BYTES = 1 << 21

# keys no record holds: one proves the line ended where it should, the other
# stands for content that is checked but not kept
_END = "end_of_line_7f3a9c51"
_SKIPPED = "skipped_7f3a9c51"


def read_lines(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """One row per line, with the file and block it came from.

    Partition directories below ``paths`` become columns (``basePath`` option).
    """
    lines = spark.read.options(lineSep="\n", **options).text(paths)
    return with_origin(lines)


def with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def read_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Records of all ``paths`` in one scan, with their file.

    Without ``schema`` Spark reads everything once more to infer it; pass a
    registered schema to avoid that. Options are the JSON reader's, such as
    ``samplingRatio`` or ``ignoreMissingFiles``.
    """
    reader = spark.read.options(lineSep="\n", **STRICT_JSON, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def is_record(line: Column) -> Column:
    """Whether the whole line is exactly one JSON object."""
    wrapped = F.concat(F.lit('{"r":['), line, F.lit(f'],"{_END}":true}}'))
    # one comparison, so that the line is parsed once
    one_object = F.struct(F.array(F.struct(F.lit(None))), F.lit(True))
    type_ = f"struct<r:array<struct<{_SKIPPED}:string>>,{_END}:boolean>"
    return F.from_json(wrapped, type_, STRICT_JSON).eqNullSafe(one_object.cast(type_))


def is_filled(line: Column) -> Column:
    return line.rlike(r"\S")


def is_oversized(line: Column) -> Column:
    """Whether a record is beyond the size of a VARIANT; only long lines are tried."""
    long = F.octet_length(line) > VARIANT_SAFE_BYTES
    return F.when(long, F.try_parse_json(line).isNull()).otherwise(F.lit(False))


def parse_record(line: Column, schema: T.StructType) -> Column:
    return F.from_json(line, schema, STRICT_JSON)


def parse_lines(lines: DataFrame, schema: T.StructType, *, text: str | None = None) -> DataFrame:
    """The records of lines, one column per field, next to the other columns.

    Blank lines, which may surround the content of a good file, hold no record.
    ``text`` keeps the line itself under that name.
    """
    others = [c for c in lines.columns if c not in ("value", BLOCK, *schema.names)]
    kept = [F.col(quoted(c)) for c in others]
    if text is not None:
        kept.append(F.col("value").alias(text))
    # as a generator the record is parsed once: filters on its fields, which
    # would repeat the parse below a projection, stay above
    fields = F.inline_outer(F.array(parse_record(F.col("value"), schema)))
    return lines.where(is_filled(F.col("value"))).select(*kept, fields)


def judge_lines(lines: DataFrame, *, as_variant: bool = False) -> DataFrame:
    """Add what ``audit_files`` has to know of each line.

    Bytes that are no UTF-8, which a reader of text would replace in silence,
    make a line bad, and ``as_variant`` so does a record too large for a VARIANT.
    """
    value = F.col("value")
    filled = is_filled(value)
    good = F.is_valid_utf8(value) & is_record(value)
    if as_variant:
        good &= ~is_oversized(value)
    return lines.select(
        "*",
        filled.alias(FILLED),
        (filled & ~good).alias(BAD),
        F.monotonically_increasing_id().alias(POSITION),
    )


def parse_and_judge(
    lines: DataFrame, schema: T.StructType, *, text: str | None = None
) -> DataFrame:
    """Records and verdicts of all lines in one pass over the text.

    Blank and bad lines stay, as rows of nulls, for ``audit_files`` to count;
    take the records from the filled rows of good files. ``text`` keeps the
    line of a record under that name.
    """
    judged = judge_lines(lines)
    value = F.when(F.col(FILLED) & ~F.col(BAD), F.col("value"))
    others = [F.col(quoted(c)) for c in judged.columns if c not in ("value", *schema.names)]
    kept = [] if text is None else [value.alias(text)]
    return judged.select(*others, *kept, F.inline_outer(F.array(parse_record(value, schema))))


def unit_of(unit_pattern: str | None) -> Column:
    """What counts as one file: the path, or the part a pattern captures.

    A directory that a Spark job wrote in parts is one file to its readers.
    """
    path = F.col(SOURCE_FILE)
    return path if unit_pattern is None else F.regexp_extract(path, unit_pattern, 1)


def audit_files(lines: DataFrame, *, unit_pattern: str | None = None) -> DataFrame:
    """One row per file: lines, records, bad lines, and whether it is rejected.

    Blank lines around the content are ignored; a blank line inside it is a
    bad line, and a file without content is rejected. The result is a written
    table, small next to the data: aggregation starts in the scan and only one
    row per file block is shuffled. ``lines`` may be judged already.
    """
    filled, position = F.col(FILLED), F.col(POSITION)
    if FILLED not in lines.columns:
        lines = judge_lines(lines)
    blocks = (
        lines.select(*ORIGIN)
        .groupBy(SOURCE_FILE, BLOCK)
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.count(F.when(filled, 1)).alias("_filled"),
            F.count_if(BAD).alias("_broken"),
            F.min(position).alias("_start"),
            F.min(F.when(filled, position)).alias("_first"),
            F.max(F.when(filled, position)).alias("_last"),
        )
    )
    whole_file = Window.partitionBy(SOURCE_FILE)
    block, has_content = F.col(BLOCK), F.col("_filled") > 0
    spans = blocks.select(
        "*",
        F.min(F.when(has_content, block)).over(whole_file).alias("_from"),
        F.max(F.when(has_content, block)).over(whole_file).alias("_to"),
    )
    before = F.when(block == F.col("_from"), F.col("_first") - F.col("_start"))
    after = F.when(
        block == F.col("_to"), F.col("_lines") - 1 - (F.col("_last") - F.col("_start"))
    )
    outside = F.when((block < F.col("_from")) | (block > F.col("_to")), F.col("_lines"))
    around = sum((F.coalesce(c, F.lit(0)) for c in (before, after, outside)), F.lit(0))
    inside_blanks = F.when(
        F.col("_from").isNotNull(), F.col("_lines") - F.col("_filled") - around
    ).otherwise(0)

    files = spans.groupBy(unit_of(unit_pattern).alias("unit")).agg(
        F.sum("_lines").alias("n_rows"),
        F.sum("_filled").alias("n_records"),
        F.sum(F.col("_broken") + inside_blanks).alias("n_bad"),
    )
    rejected = (F.col("n_bad") > 0) | (F.col("n_records") == 0)
    return materialize(files.withColumn("rejected", rejected), "file-audit")


def keep_good(
    df: DataFrame,
    audit: DataFrame,
    *,
    unit_pattern: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of ``df`` (with its source file) whose file is not rejected."""
    keys = audit.select(F.col("unit").alias("_unit"), "n_rows", F.col("rejected").alias("_rejected"))
    marked = attach(
        df.withColumn("_unit", unit_of(unit_pattern)),
        keys,
        "_unit",
        F.col("_rejected"),
        broadcast_bytes=broadcast_bytes,
    )
    return marked.where(F.col("_rejected").isNull()).select(*[F.col(quoted(c)) for c in df.columns])


def rejected_files(audit: DataFrame) -> DataFrame:
    return audit.where("rejected")


def count_files(audit: DataFrame) -> DataFrame:
    """Files and records seen and kept: the report of one ingest run."""
    kept = ~F.col("rejected")
    return audit.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count(F.when(kept, 1)).alias("n_files_kept"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"),
        F.coalesce(F.sum(F.when(kept, F.col("n_records"))), F.lit(0)).alias("n_records_kept"),
    )
