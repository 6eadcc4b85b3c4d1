"""Verdicts over batches, absent files, and counts in passing."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.counts import StageReport
from recordlake.sources.tables import read_tables
from recordlake.streaming.arrivals import absent_files, write_absent
from recordlake.streaming.incremental import accepted, ingest_units, verdicts

SCHEMA = T.StructType([T.StructField("a", T.LongType())])
UNIT = r"^(.*/unit=[^/]+)/"


@pytest.fixture
def units(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def arrive(unit, name, text, **options):
        (landing / f"unit={unit}").mkdir(parents=True, exist_ok=True)
        (landing / f"unit={unit}" / name).write_text(text)

    def run(**options):
        ingest_units(spark, str(landing), SCHEMA, out, str(tmp_path / "cp"), unit_pattern=UNIT, **options)
        return sorted(r.a for r in accepted(spark, out, unit_pattern=UNIT).collect())

    return arrive, run, out


def test_a_bad_file_in_a_later_batch_rejects_its_whole_unit(spark, units):
    arrive, run, out = units
    arrive("x", "1", '{"a":1}\n{"a":2}\n')
    arrive("y", "1", '{"a":3}\n')
    assert run() == [1, 2, 3]
    arrive("x", "2", '{"a":4}\n{"a"\n')
    arrive("y", "2", '{"a":5}\n')
    assert run() == [3, 5]
    assert run() == [3, 5]  # nothing new
    arrive("x", "3", '{"a":6}\n')
    arrive("z", "1", "\n")
    assert run() == [3, 5]
    rows = {r.unit[-1]: (r.n_records, r.n_bad, r.rejected) for r in verdicts(spark, out).collect()}
    assert rows == {"x": (5, 1, True), "y": (2, 0, False), "z": (0, 0, True)}


def test_one_file_a_batch_gives_the_same_verdicts(spark, units):
    arrive, run, out = units
    for i, text in enumerate(('{"a":1}\n', '{"a":2}\nno\n', '{"a":3}\n')):
        arrive("x", str(i), text)
        arrive("y", str(i), text.replace("no\n", ""))
    assert run(files_per_batch=1) == [1, 2, 3]
    assert {r.unit[-1]: r.n_bad for r in verdicts(spark, out).collect()} == {"x": 1, "y": 0}
    assert read_tables(spark, f"{out}/records").count() == 6


def at(hours):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)


def test_absent_files_come_out_once_their_time_has_passed(spark, tmp_path):
    schemas = "url string, promised_at timestamp", "url string, arrived_at timestamp"
    folders = str(tmp_path / "promised"), str(tmp_path / "arrived")
    waves = [
        ([("a", at(0)), ("b", at(0)), ("c", at(1)), (None, at(1))], [("a", at(2))]),
        ([("d", at(20)), ("d", at(21))], [("b", at(23)), ("c", at(26))]),  # c comes a day late
        ([("x", at(100))], [("d", at(30)), ("x", at(100))]),
    ]
    absent = []
    for wave in waves:
        for rows, schema, folder in zip(wave, schemas, folders):
            spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        streams = [spark.readStream.schema(s).parquet(f) for s, f in zip(schemas, folders)]
        write_absent(absent_files(*streams), str(tmp_path / "out"), str(tmp_path / "cp"))
        found = spark.read.schema(schemas[0]).parquet(str(tmp_path / "out")).collect()
        absent.append(sorted(str(r.url) for r in found))
    assert absent[0] in ([], ["None"])  # nothing has run out
    assert absent[2] == ["None", "c"]


def test_stage_counts_need_no_job_of_their_own(spark, tmp_path):
    report = StageReport()
    df = report.watch(spark.range(100).toDF("x"), read=F.lit(True), even=F.col("x") % 2 == 0)
    kept = report.watch(df.where("x > 89"), kept=F.lit(True))
    kept.write.parquet(str(tmp_path / "out"))
    assert {r.stage: r.n for r in report.rows(spark).collect()} == {"read": 100, "even": 50, "kept": 10}
