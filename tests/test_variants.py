"""Schemas and key paths found in stored records, and what is done with them."""

import gzip
import json
from pathlib import Path

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake import fixtures
from recordlake.functions.values import with_declared_fields
from recordlake.operators.flatten import flatten
from recordlake.operators.staging import Rule, StageSpec, stage
from recordlake.sources import ndjson, variants


@pytest.fixture
def stored(spark, tmp_path):
    count = iter(range(100))

    def build(*lines, **levels):
        path = tmp_path / f"in-{next(count)}"
        path.mkdir()
        text = [x if isinstance(x, bytes) else json.dumps(x).encode() for x in lines]
        (path / "a.ndjson").write_bytes(b"\n".join(text) + b"\n")
        return variants.read_records(spark, str(path))

    return build


MIXED = [
    {"x": 1, "y": {"z": [{"k": 1.5, "m q": None}, {"k": 2, "n": "s"}]}, "e": [], "VOID": None, "o": {}},
    {"x": "t", "y": {"w": True}, "big": 10**29, "d": 3.0, "f": 1e30, "a`b": 1, "OBJECT<": 2},
    {"x": 2, "a": [1, [2]], "m": [{"q": 1}, 5], "mix": {"p": 1}},
    {"mix": [1], "long": 5},
    {"long": 10**25},
]


def test_both_ways_to_a_schema_agree(stored):
    records = stored(*MIXED, b"", b"not json", b"[1]")
    (schema,) = variants.infer_schemas(records, []).values()
    census = variants.key_census(records).collect()
    assert variants.schema_of_census(census) == schema
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert types["x"] == types["mix"] == "string" and types["d"] == types["f"] == "double"
    assert types["long"] == "decimal(26,0)" and types["e"] == "array<string>" and "o" not in types
    assert types["y"] == "struct<w:boolean,z:array<struct<k:double,m q:string,n:string>>>"
    rows = variants.with_columns(records, schema).collect()
    assert len(rows) == len(MIXED)
    by_x = {r.x: r for r in rows}
    assert set(by_x) == {"1", "t", "2", None} and by_x["2"].m == ['{"q":1}', "5"]
    assert by_x["t"]["a`b"] == 1 and by_x["t"]["OBJECT<"] == 2


def test_whole_numbers_stay_whole_beside_decimals(spark, tmp_path):
    for user, value in (("1", 1), ("2", 1.5)):
        (tmp_path / f"user_id={user}").mkdir()
        (tmp_path / f"user_id={user}" / "a.ndjson").write_text(json.dumps({"v": value}) + "\n")
    found = variants.infer_schemas(variants.read_records(spark, str(tmp_path)), ["user_id"])
    assert {k: s.simpleString() for k, s in found.items()} == {
        ("1",): "struct<v:bigint>",
        ("2",): "struct<v:double>",
    }


def test_text_is_scanned_once(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"a":1}\n')
    records = variants.read_records(spark, str(tmp_path))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Format: Text" not in plan and "Parquet" in plan


def test_counts_of_the_census(stored):
    rows = variants.key_census(stored({"a": [{"b": 1}, {"b": None}, {}]}, {"a": []}, {"a": "t"})).collect()
    assert {(tuple(r.path), r.type): r.n for r in rows} == {
        (("a",), "ARRAY"): 2, (("a",), "STRING"): 1, (("a", None), "OBJECT"): 3,
        (("a", None, "b"), "BIGINT"): 1, (("a", None, "b"), "VOID"): 1,
    }


def test_no_records(stored):
    records = stored(b"", b"x")
    assert variants.key_census(records).count() == 0 and variants.infer_schemas(records, []) == {}
    assert variants.schema_of_census([]) == T.StructType([])


def test_undeclared_keys_are_flattened(stored):
    declared = T.StructType.fromDDL("id string, a struct<b:bigint>, l array<struct<k:string>>")
    records = stored(
        {"id": "1", "a": {"b": 1, "newKey": "x"}, "l": [{"k": "p", "q": 1}, {"q": 2}], "own": {"deepKey": [True]}},
        {"id": "2", "a": {"b": 2}},
    )
    census = variants.key_census(records)
    paths = {tuple(r.path) for r in variants.undeclared(census, declared).collect()}
    assert paths == {("a", "newKey"), ("l", None, "q"), ("own",), ("own", "deepKey"), ("own", "deepKey", None)}
    schema = variants.merged(declared, variants.schema_of_census(census.collect()))
    assert [f.name for f in schema.fields] == ["id", "a", "l", "own"]
    flat = flatten(variants.with_columns(records.select(variants.RECORD), schema))
    first = {r.id: r for r in flat.collect()}["1"]
    assert (first.a__b, first.a__new_key, first.l__k, first.l__q) == (1, "x", ["p"], [1, 2])
    assert first.own__deep_key == [True]


def test_declared_types_win():
    declared = T.StructType.fromDDL("a string, b struct<c:bigint>, d array<bigint>")
    found = T.StructType.fromDDL("a bigint, b struct<c:string,e:double>, d string, f boolean")
    assert variants.merged(declared, found).simpleString() == (
        "struct<a:string,b:struct<c:bigint,e:double>,d:array<bigint>,f:boolean>"
    )


# nested repair


def test_missing_inner_fields_are_null(spark):
    have = "v array<struct<code:string, inner:struct<a:int>>>"
    want = T.ArrayType(T.StructType.fromDDL("code string, value double, inner struct<a:int,b:string>, more array<int>"))
    df = spark.createDataFrame([([("x", (1,)), None, ("y", None)],), ([],), (None,)], have)
    out = df.select(with_declared_fields(F.col("v"), df.schema["v"].dataType, want).alias("v")).collect()
    assert [None if x is None else x.asDict(recursive=True) for x in out[0].v] == [
        {"code": "x", "inner": {"a": 1, "b": None}, "value": None, "more": None},
        None,
        {"code": "y", "inner": None, "value": None, "more": None},
    ]
    assert out[1].v == [] and out[2].v is None


def test_staging_repairs_lists_that_are_there(spark):
    quantity = T.ArrayType(T.StructType.fromDDL("code string, value double"))
    spec = StageSpec("t", (Rule("low", absent=quantity), Rule("high", absent=quantity)))
    df = spark.createDataFrame([([("c",)], [("c", 1.0, 2)])], "low array<struct<code:string>>, high array<struct<code:string,value:double,own:int>>")
    row = stage(df, spec, participant="p").first()
    assert row.low[0].value is None and row.low[0].code == "c" and row.high[0].own == 2
    text = spark.createDataFrame([("never a list",)], "low string")
    assert stage(text, spec, participant="p").first().low is None


# bytes and sizes


def test_bytes_that_are_no_utf8_make_a_line_bad(spark, tmp_path):
    (tmp_path / "good.ndjson").write_bytes('{"a":"café"}\n'.encode())
    (tmp_path / "latin.ndjson").write_bytes('{"a":"café"}\n'.encode("latin-1"))
    (tmp_path / "half.ndjson").write_bytes(b'{"a":1}\n{"a":"\xf0\x9f\x98"}\n')
    audit = ndjson.audit_files(ndjson.read_lines(spark, str(tmp_path))).collect()
    assert {r.unit.rsplit("/", 1)[1]: (r.n_records, r.n_bad) for r in audit} == {
        "good.ndjson": (1, 0), "latin.ndjson": (1, 1), "half.ndjson": (2, 1),
    }


def test_large_records_are_tried(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ndjson, "VARIANT_SAFE_BYTES", 100)
    (tmp_path / "a.ndjson").write_text(json.dumps({"a": "x" * 500}) + "\n")
    assert ndjson.audit_files(variants.read_records(spark, str(tmp_path))).first().n_bad == 0


def test_census_looks_for_types_of_plain_values_once(stored, monkeypatch):
    records = stored({"a": {"b": {"c": [{}, [], [1, None]]}}}, {"a": {"b": 1.5}, "d": None})
    plans, write = [], variants.materialize

    def watched(df, label):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return write(df, label)

    monkeypatch.setattr(variants, "materialize", watched)
    found = {(*r["path"], r["type"]): r["n"] for r in variants.key_census(records).collect()}
    c = ("a", "b", "c")
    assert found == {
        ("a", "OBJECT"): 2, ("a", "b", "OBJECT"): 1, ("a", "b", "DECIMAL"): 1, ("d", "VOID"): 1,
        (*c, "ARRAY"): 1, (*c, None, "OBJECT"): 1, (*c, None, "ARRAY"): 2,
        (*c, None, None, "BIGINT"): 1, (*c, None, None, "VOID"): 1,
    }
    # a deeper level does not look again for what those above it looked for
    assert len(plans) == 5 and len({plan.count("schema_of_variant(") for plan in plans}) == 1


def test_undeclared_files_are_small_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "RECORDS_PER_FILE", 200)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(3000)
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    root = Path(fixtures.undeclared_files(spark, str(tmp_path)))
    texts = [gzip.decompress(f.read_bytes()) for f in root.glob("*.txt.gz")]
    assert not list(root.glob("*.txt")) and max(text.count(b"\n") for text in texts) == 200
    assert sum(text.count(b"\n") for text in texts) == 3000
    # a plain text of 6 GB of tables, with the stored records, does not fit 70 GB
    assert sum(f.stat().st_size for f in root.glob("*.gz")) < sum(map(len, texts)) / 4
    stored = Path(variants.read_records(spark, str(root)).inputFiles()[0].removeprefix("file:"))
    assert stored.name.endswith(".zstd.parquet")
