"""The whole way from raw NDJSON to the record table."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.names import quoted
from recordlake.operators.counts import StageReport
from recordlake.operators.flatten import flatten
from recordlake.operators.staging import stage
from recordlake.operators.unify import unify
from recordlake.plans.specs import STAGING, used_columns
from recordlake.session import materialize
from recordlake.sources.layout import lineage
from recordlake.sources.ndjson import (
    BAD,
    FILLED,
    ORIGIN,
    audit_files,
    keep_good,
    parse_and_judge,
    read_lines,
)

_TEXT = "_record_text"
_PARTICIPANT, _INPUT = "_participant", "_input"


def medical_records(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, T.StructType],
    *,
    as_of: str | datetime.datetime | None = None,
    unit_pattern: str | None = None,
    report: StageReport | None = None,
) -> DataFrame:
    """The record table from one raw path and one schema per record type.

    ``paths`` lie in the landing layout: the participant is the ``user_id``
    level of a file's path, null where there is none. Source, version and
    participant together are one input, and each input of a type is staged as
    if alone. Files that hold a bad line are left out. Nulls written out in
    lists are kept.

    ``report`` counts the lines read, filled and bad, and the records kept and
    staged, as the jobs run over them.

    The text is read once: flattened records are stored in scratch with their
    file, and files and inputs are judged from a few stored columns.
    """
    stored = {t: _stored(spark, path, t, schemas[t], report) for t, path in paths.items()}
    origins = functools.reduce(
        DataFrame.unionByName, [df.select(*ORIGIN) for df in stored.values()]
    )
    audit = audit_files(origins, unit_pattern=unit_pattern)
    staged = {}
    for resource_type, flat in stored.items():
        good = keep_good(flat.where(FILLED), audit, unit_pattern=unit_pattern)
        staged[resource_type] = stage(
            good if report is None else report.watch(good, kept=F.lit(True)),
            STAGING[resource_type],
            participant=F.col(_PARTICIPANT),
            as_of=as_of,
            input_id=_INPUT,
        )
        if report is not None:
            staged[resource_type] = report.watch(staged[resource_type], staged=F.lit(True))
    return unify(staged)


def _stored(spark, path, resource_type, schema, report) -> DataFrame:
    lines = read_lines(spark, path, recursiveFileLookup="true")
    records = parse_and_judge(lines, schema, text=_TEXT)
    if report is not None:
        records = report.watch(records, read=F.lit(True), filled=F.col(FILLED), bad=F.col(BAD))
    flat = flatten(records, text=_TEXT, carry=ORIGIN)
    level = lineage()
    of_input = F.struct(*[level[c].alias(c) for c in ("source", "version", "user_id")])
    used = used_columns(resource_type)
    return materialize(
        flat.select(
            *ORIGIN,
            level["user_id"].alias(_PARTICIPANT),
            F.to_json(of_input).alias(_INPUT),
            *[F.col(quoted(c)) for c in flat.columns if c in used],
        ),
        f"flat-{resource_type}",
    )
