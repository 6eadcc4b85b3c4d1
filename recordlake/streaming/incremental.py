"""Ingest newly arrived NDJSON files, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from recordlake.session import materialize
from recordlake.sources.ndjson import (
    BAD,
    FILLED,
    ORIGIN,
    SOURCE_FILE,
    audit_files,
    keep_good,
    parse_and_judge,
    rejected_files,
    with_origin,
)
from recordlake.sources.tables import read_tables

BATCH = "ingest_batch"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    rejects: str,
    *,
    files_per_batch: int | None = None,
    unit_pattern: str | None = None,
) -> None:
    """Process all files that arrived since the last call, then return.

    The checkpoint remembers which files are done. A micro-batch writes the
    partition named after it, so a batch repeated after a failure replaces its
    own output; use one checkpoint per ``output``. A file is never split over
    batches, so a bad line rejects its whole file here too; rejected files are
    listed under ``rejects``. ``files_per_batch`` bounds a batch when many
    files wait. ``unit_pattern`` makes a directory one file, as in ``audit_files``;
    it must then arrive in one batch.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = with_origin(reader.text(landing))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the text is read once: what was parsed is stored, judged and filtered
        stored = materialize(parse_and_judge(batch, schema), "arrivals")
        audit = audit_files(stored, unit_pattern=unit_pattern)
        good = keep_good(stored.where(FILLED), audit, unit_pattern=unit_pattern)
        _write(good.drop(*[c for c in ORIGIN if c != SOURCE_FILE]), output, batch_id)
        _write(rejected_files(audit), rejects, batch_id)

    _run(lines.writeStream.foreachBatch(write_batch), checkpoint)


def ingest_units(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    *,
    unit_pattern: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Ingest new files of units, such as directories, that arrive over several batches.

    A unit is good as long as all its files are: a bad line that comes later
    rejects what was taken before. Below ``output``, ``records`` keeps the good
    lines of every file, ``files`` the findings on each batch's files, and
    ``verdicts`` the sums of a unit so far. These are keyed streaming state: a
    second stream over the findings adds to the unit's sums, whatever batch or
    call they came in, and writes the units that changed. ``accepted`` reads the
    records of units that are good by now.

    The second stream starts when the first has ended, so it sees no batch that
    is to be repeated. Nothing is kept per record, and per unit a few numbers.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stored = materialize(parse_and_judge(batch, schema), "arrivals")
        good = stored.where(F.col(FILLED) & ~F.col(BAD))
        _write(good.drop(*[c for c in ORIGIN if c != SOURCE_FILE]), f"{output}/records", batch_id)
        _write(audit_files(stored, unit_pattern=unit_pattern), f"{output}/files", batch_id)

    lines = with_origin(reader.text(landing))
    _run(lines.writeStream.foreachBatch(write_batch), f"{checkpoint}/records")

    findings = spark.readStream.schema(_FINDINGS).parquet(f"{output}/files")
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_records", "n_bad")]
    changed = findings.groupBy("unit").agg(*sums).writeStream.outputMode("update")
    _run(
        changed.foreachBatch(lambda batch, i: _write(batch, f"{output}/verdicts", i)),
        f"{checkpoint}/verdicts",
    )


_FINDINGS = "unit string, n_rows bigint, n_records bigint, n_bad bigint"


def verdicts(spark: SparkSession, output: str) -> DataFrame:
    """One row per unit as it stands now: lines, records, bad lines, and whether it is rejected."""
    written = spark.read.schema(f"{_FINDINGS}, {BATCH} bigint").parquet(f"{output}/verdicts")
    latest = F.max_by(F.struct("n_rows", "n_records", "n_bad"), BATCH).alias("now")
    rejected = (F.col("n_bad") > 0) | (F.col("n_records") == 0)
    now = written.groupBy("unit").agg(latest).select("unit", "now.*")
    return now.withColumn("rejected", rejected)


def accepted(spark: SparkSession, output: str, *, unit_pattern: str | None = None) -> DataFrame:
    """The records of all units that are good by now."""
    records = read_tables(spark, f"{output}/records")
    now = materialize(verdicts(spark, output), "verdicts")
    return keep_good(records, now, unit_pattern=unit_pattern)


def _run(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what there is, once."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BATCH).parquet(path)
