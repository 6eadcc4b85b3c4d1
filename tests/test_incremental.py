from pyspark.sql import types as T

from recordlake.sources.tables import read_tables
from recordlake.streaming.incremental import ingest_new_files

SCHEMA = T.StructType([T.StructField("a", T.LongType())])


def test_each_file_once_and_bad_files_set_aside(spark, tmp_path):
    landing, out, rejects = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    landing.mkdir()

    def run(**options):
        ingest_new_files(spark, str(landing), SCHEMA, out, str(tmp_path / "cp"), rejects, **options)

    (landing / "one").write_text('{"a":1}\n{"a":2}\n\n')
    (landing / "bad").write_text('{"a":3}\n{"a"\n')
    run()
    assert sorted(r.a for r in read_tables(spark, out).collect()) == [1, 2]
    run()  # nothing new
    assert read_tables(spark, out).count() == 2

    for i in range(3):
        (landing / f"late{i}").write_text(f'{{"a":{10 + i}}}\n')
    run(files_per_batch=1)
    rows = read_tables(spark, out).collect()
    assert sorted(r.a for r in rows) == [1, 2, 10, 11, 12]
    assert len({r.ingest_batch for r in rows}) == 4
    assert [r.unit.rsplit("/", 1)[1] for r in read_tables(spark, rejects).collect()] == ["bad"]


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "one").write_text('{"a":1}\n')
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint starts over at batch 0
        ingest_new_files(
            spark, str(landing), SCHEMA, out, str(tmp_path / checkpoint), str(tmp_path / "bad")
        )
    assert read_tables(spark, out).count() == 1
