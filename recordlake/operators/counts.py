"""Row counts of each stage of a run, taken in passing from the jobs that run anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "stage string, n bigint"


class StageReport:
    """Counts what passes the watched places of a plan; no job runs for it.

    A place is counted by the first action that runs over it to its end. Where a
    lost executor makes a task run again, Spark counts what the winning task
    saw of a job's result; a stage before a shuffle that is computed twice may
    count twice, so the counts are a report, not a verdict (``audit_files``
    gives those).
    """

    def __init__(self) -> None:
        self._watched: list[Observation] = []

    def watch(self, df: DataFrame, **stages: Column) -> DataFrame:
        """``df``, counting for each named stage the rows on which its column is true."""
        seen = Observation()
        self._watched.append(seen)
        counts = [F.count_if(when).alias(stage) for stage, when in stages.items()]
        return df.observe(seen, *counts)

    def rows(self, spark: SparkSession) -> DataFrame:
        """``stage, n``, summed over the places of one name; call it when all has run.

        It waits for an action that has not run.
        """
        totals: dict[str, int] = {}
        for seen in self._watched:
            for stage, n in seen.get.items():
                totals[stage] = totals.get(stage, 0) + n
        return spark.createDataFrame(sorted(totals.items()), REPORT)
