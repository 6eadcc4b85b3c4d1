"""Which files a manifest promised and which never came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_files(
    promised: DataFrame,
    arrived: DataFrame,
    *,
    key: str = "url",
    promised_at: str = "promised_at",
    arrived_at: str = "arrived_at",
    wait: str = "1 day",
    lateness: str = "1 hour",
) -> DataFrame:
    """The rows of ``promised`` for which no file arrived within ``wait``, as a stream.

    Both are streams: entries of manifests with the time they were promised,
    and files with the time they came. They are joined by key and time, so the
    state holds a promise for ``wait`` and no longer; once both streams have
    passed that time (less ``lateness``, by which rows may be out of order) a
    promise without a file comes out, once. A file that comes later does not
    count. Of a promise made twice each is judged by itself; a promise
    with a null key or time never has a file. Both streams must go on, by rows
    with a key, for a promise to run out.
    """
    left = promised.withWatermark(promised_at, lateness)
    right = arrived.select(
        F.col(key).alias("_came"), F.col(arrived_at).alias("_came_at")
    ).withWatermark("_came_at", lateness)
    in_time = (F.col("_came_at") >= F.col(promised_at)) & (
        F.col("_came_at") <= F.col(promised_at) + F.expr(f"INTERVAL {wait}")
    )
    joined = left.join(right, (F.col(key) == F.col("_came")) & in_time, "left_outer")
    return joined.where(F.col("_came_at").isNull()).select(*promised.columns)


def write_absent(absent: DataFrame, output: str, checkpoint: str) -> None:
    """Append what is known to be absent by now to ``output``, and return.

    Call it again when more has come: the checkpoint keeps the open promises.
    """
    query = (
        absent.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
