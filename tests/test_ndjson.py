"""Whole-file rejection, against a plain reading of each file."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.sources import ndjson

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("f", T.StringType())])


def file_is_good(content: bytes) -> bool:
    """The rule, file by file: strip it, split it, every line is one object."""
    for line in content.decode().strip().split("\n"):
        try:
            if not isinstance(json.loads(line), dict):
                return False
        except json.JSONDecodeError:
            return False
    return True


def write_files(folder, contents):
    folder.mkdir()
    for name, content in contents.items():
        data = gzip.compress(content) if name.endswith(".gz") else content
        (folder / name).write_bytes(data)
    return str(folder)


def verdicts(spark, path):
    audit = ndjson.audit_files(ndjson.read_lines(spark, path))
    rows = audit.select(F.regexp_extract("unit", "([^/]+)$", 1).alias("name"), "rejected")
    return {r.name: not r.rejected for r in rows.collect()}


LINES = {
    "plain": b'{"a":1}\n{"a":2}\n',
    "no_final_newline": b'{"a":1}\n{"a":2}',
    "cut": b'{"a":1}\n{"a":\n',
    "trailing_text": b'{"a":1} x\n',
    "two_objects": b'{"a":1}{"a":2}\n',
    "two_with_comma": b'{"a":1},{"a":2}\n',
    "closes_too_often": b'{"a":1}}\n',
    "escapes_the_list": b'{"a":1}] [\n',
    "extra_member": b'{"a":1},"x":2\n',
    "top_list": b"[1]\n",
    "top_list_of_objects": b'[{"a":1}]\n',
    "top_number": b"5\n",
    "top_null": b"null\n",
    "single_quotes": b"{'a':1}\n",
    "leading_zero": b'{"a":01}\n',
    "final_comma": b'{"a":1,}\n',
    "tab_in_text": b'{"f":"x\ty"}\n',
    "empty_object": b"{}\n",
    "repeated_key": b'{"a":1,"a":2}\n',
    "spaces_around": b'  {"a":1}  \n',
    "carriage_returns": b'{"a":1}\r\n{"a":2}\r\n',
    "other_type": b'{"a":"text"}\n{"a":{"b":[1,2,{}]}}\n',
    "unicode": '{"f":"é\\u00e9 \\ud83d\\ude00"}\n'.encode(),
    "blank_before_and_after": b'\n\n{"a":1}\n{"a":2}\n\n \n',
    "blank_inside": b'{"a":1}\n\n{"a":2}\n',
    "spaces_inside": b'{"a":1}\n  \n{"a":2}\n',
    "only_blanks": b"\n \n\n",
    "zipped.gz": b'{"a":1}\n{"a":2}\n',
    "zipped_cut.gz": b'{"a":1}\n{"a"\n',
}


def test_every_kind_of_line(spark, tmp_path):
    got = verdicts(spark, write_files(tmp_path / "in", LINES))
    assert got == {name: file_is_good(content) for name, content in LINES.items()}


def test_empty_file_is_not_kept(spark, tmp_path):
    path = write_files(tmp_path / "in", {"empty": b"", "plain": LINES["plain"]})
    assert verdicts(spark, path) == {"plain": True}


def test_blank_lines_in_files_of_many_blocks(spark, tmp_path):
    rng = random.Random(11)
    contents = {}
    for i in range(25):
        lines = [f'{{"a":{rng.randrange(10**9)}}}' for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", " "]))
        lines = [""] * rng.choice([0, 0, 3, 40]) + lines + [""] * rng.choice([0, 0, 3, 40])
        contents[f"f{i}"] = ("\n".join(lines) + "\n").encode()
    path = write_files(tmp_path / "in", contents)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = ndjson.read_lines(spark, path)
        assert lines.select(ndjson.SOURCE_FILE, ndjson.BLOCK).distinct().count() > 60
        got = verdicts(spark, path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    wanted = {name: file_is_good(content) for name, content in contents.items()}
    assert got == wanted
    assert 0 < sum(wanted.values()) < len(wanted)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_good_rows_are_kept_whole(spark, tmp_path, broadcast_bytes):
    path = write_files(tmp_path / "in", LINES)
    audit = ndjson.audit_files(ndjson.read_lines(spark, path))
    rows = ndjson.read_ndjson(spark, path, SCHEMA)
    good = ndjson.keep_good(rows, audit, broadcast_bytes=broadcast_bytes)
    assert good.columns == rows.columns
    names = good.groupBy(F.regexp_extract(ndjson.SOURCE_FILE, "([^/]+)$", 1).alias("n")).count()
    wanted = {
        name: sum(1 for line in content.decode().strip().split("\n"))
        for name, content in LINES.items()
        if file_is_good(content)
    }
    assert {r.n: r["count"] for r in names.collect()} == wanted

    counts = ndjson.count_files(audit).first()
    assert counts.n_files == len(LINES)
    assert counts.n_files_kept == len(wanted)
    assert counts.n_records_kept == sum(wanted.values())
    assert ndjson.rejected_files(audit).count() == len(LINES) - len(wanted)


def test_directories_can_count_as_files(spark, tmp_path):
    for name, line in (("x.ndjson", '{"a":1}'), ("y.ndjson", '{"a"')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0").write_text('{"a":1}\n')
        (tmp_path / name / "part-1").write_text(line + "\n")
    pattern = r"^(.*\.ndjson)/"
    lines = ndjson.read_lines(spark, str(tmp_path / "*.ndjson"))
    audit = ndjson.audit_files(lines, unit_pattern=pattern)
    assert audit.count() == 2
    rows = ndjson.read_ndjson(spark, str(tmp_path / "*.ndjson"), SCHEMA)
    good = ndjson.keep_good(rows, audit, unit_pattern=pattern)
    assert [r.a for r in good.collect()] == [1, 1]


def test_inferred_schema(spark, tmp_path):
    path = write_files(tmp_path / "in", {"x": b'{"key1":"a","key2":"b"}\n{"key1":"c"}\n'})
    df = ndjson.read_ndjson(spark, path)
    assert df.columns == ["key1", "key2", ndjson.SOURCE_FILE]
    assert df.count() == 2


def test_a_very_long_text_is_read_as_it_is_judged(spark, tmp_path):
    long = 21_000_000
    (tmp_path / "big").write_text('{"id":1,"b":"x"}\n{"id":2,"b":"' + "y" * long + '"}\n')
    lines = ndjson.read_lines(spark, str(tmp_path / "big"))
    audit = ndjson.audit_files(lines).first()
    assert (audit.n_records, audit.n_bad, audit.rejected) == (2, 0, False)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.StringType())])
    parsed = ndjson.parse_lines(lines, schema).selectExpr("id", "length(b) as n").collect()
    assert sorted((r.id, r.n) for r in parsed) == [(1, 1), (2, long)]
    read = ndjson.read_ndjson(spark, str(tmp_path / "big"), schema).selectExpr("id", "length(b) as n")
    assert sorted((r.id, r.n) for r in read.collect()) == [(1, 1), (2, long)]


def test_one_pass_judges_and_parses(spark, tmp_path):
    (tmp_path / "good").write_text('\n{"a":1}\n{"a":2,"b":"x"}\n\n')
    (tmp_path / "bad").write_text('{"a":3}\n{"a":4}}\n')
    (tmp_path / "gap").write_text('{"a":5}\n\n{"a":6}\n')
    lines = ndjson.read_lines(spark, str(tmp_path))
    schema = T.StructType.fromDDL("a long, b string")
    judged = ndjson.parse_and_judge(lines, schema, text="t")
    assert sorted(r.a for r in judged.where("a is not null").collect()) == [1, 2, 3, 5, 6]
    apart = {tuple(r) for r in ndjson.audit_files(lines).collect()}
    assert {tuple(r) for r in ndjson.audit_files(judged).collect()} == apart
    good = ndjson.keep_good(judged.where(ndjson.FILLED), ndjson.audit_files(judged))
    assert sorted((r.a, r.t) for r in good.collect()) == [(1, '{"a":1}'), (2, '{"a":2,"b":"x"}')]
