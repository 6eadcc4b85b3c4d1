"""Session settings, and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

SETTINGS = {
    # a quoted 'Z' in a pattern is read as wall-clock time of the session zone
    "spark.sql.session.timeZone": "UTC",
    # text the parser of old Spark versions would accept is null, not an error
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    # raw records may hold keys that differ only in case
    "spark.sql.caseSensitive": "true",
    # of a key written twice in one object, the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # a stored VARIANT must keep each number as it was written: shredded by a common
    # type, whole numbers come back as decimals
    "spark.sql.variant.inferShreddingSchema": "false",
    # user_id=007 must stay the text "007"
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # an overwrite replaces only the partitions it writes
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a task holds so many partitions' files open before it sorts its rows by partition;
    # sorted at once, whole rows spill where a task reads many
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def lake_session(spark: SparkSession) -> SparkSession:
    """A sibling of ``spark`` with the settings the library relies on.

    The caller's own session keeps its settings; both share one application.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the cluster names.

    Only a single-machine session without that setting falls back to a local
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="recordlake-")
    return f"{base.rstrip('/')}/recordlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to scratch and read it back.

    Used for small keyed tables that are read several times: it cuts lineage,
    survives the loss of executors and leaves exact sizes behind.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, steps: Iterable[Callable[[], Result]]) -> list[Result]:
    """Run independent Spark jobs at once, so that one's last tasks leave no cores idle.

    Results come in the order of ``steps``; the first failure is raised when all are done.
    """
    steps = [inheritable_thread_target(spark)(step) for step in steps]
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]
