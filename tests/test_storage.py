"""Layouts, tables, the schema registry and control rows."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake import fixtures
from recordlake.operators import control
from recordlake.session import SETTINGS, lake_session, scratch_dir
from recordlake.sources import layout, ndjson, registry, tables


def landing_file(root, user, model, lines, day="20240105", version="dstu2"):
    folder = root / f"source=demo/user_id={user}/version={version}/year=2024/month=01/day=05"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{day}_{model}.ndjson"
    path.write_text("".join(json.dumps(line) + "\n" for line in lines))
    return str(path)


def test_session_keeps_the_callers_settings(base_spark):
    base_spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        session = lake_session(base_spark)
        assert {k: session.conf.get(k) for k in SETTINGS} == SETTINGS
        assert base_spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        base_spark.conf.unset("spark.sql.session.timeZone")


def session_with(checkpoint_dir, master):
    """What scratch_dir asks of a session."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: checkpoint_dir),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_follows_the_cluster_setting():
    shared = session_with("hdfs://lake/checkpoints/", "yarn")
    assert scratch_dir(shared, "x").startswith("hdfs://lake/checkpoints/recordlake/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session_with(None, "yarn"), "x")
    assert "/recordlake/x-" in scratch_dir(session_with(None, "local[2]"), "x")


def test_landing_levels_stay_text_and_model_comes_from_the_name(spark, tmp_path):
    landing_file(tmp_path, "007", "Observation", [{"a": 1}])
    landing_file(tmp_path, "010", "MedicationOrder", [{"a": 2}, {"a": 3}], version="r4")
    df = ndjson.read_ndjson(spark, str(tmp_path), basePath=str(tmp_path))
    rows = df.select("a", *layout.LANDING_LEVELS, layout.lineage()["model"].alias("m")).collect()
    assert {tuple(r) for r in rows} == {
        (1, "demo", "007", "dstu2", "2024", "01", "05", "Observation"),
        (2, "demo", "010", "r4", "2024", "01", "05", "MedicationOrder"),
        (3, "demo", "010", "r4", "2024", "01", "05", "MedicationOrder"),
    }


def test_lineage_rows_per_file(spark, tmp_path):
    one = landing_file(tmp_path, "007", "Observation", [{"a": 1}])
    two = landing_file(tmp_path, "007", "Immunization", [{"a": 1}, {"a": 2}])
    audit = ndjson.audit_files(ndjson.read_lines(spark, str(tmp_path)))
    rows = {r.path.removeprefix("file:"): r for r in layout.describe_files(audit).collect()}
    assert set(rows) == {one, two}
    assert rows[two].asDict() | {"path": None} == {
        "path": None, "source": "demo", "user_id": "007", "version": "dstu2",
        "model": "Immunization", "n_records": 2, "rejected": False,
    }


def test_listing_and_missing_files(spark, tmp_path):
    landing_file(tmp_path, "007", "Observation", [{"a": 1}])
    (tmp_path / "note.txt").write_text("x")
    files = layout.list_files(spark, str(tmp_path), "*.ndjson")
    assert files.count() == 1 and files.columns == ["path", "length"]
    keyed = files.select(F.regexp_extract("path", "user_id=([^/]+)/", 1).alias("user_id"))
    wanted = spark.createDataFrame([("007",), ("008",)], "user_id string")
    rows = layout.mark_missing(wanted, keyed, "user_id").collect()
    assert {(r.user_id, r.n_files, r.found) for r in rows} == {("007", 1, True), ("008", 0, False)}


def test_listed_files_that_are_gone_are_skipped(spark, tmp_path):
    one = landing_file(tmp_path, "007", "Observation", [{"a": 1}])
    two = landing_file(tmp_path, "010", "MedicationOrder", [{"a": 2}])
    gone = one.replace("007", "008")
    names = [path.removeprefix(f"{tmp_path}/") for path in (one, gone, two)]

    def read(names):
        path = layout.skip_missing(str(tmp_path), names)
        return ndjson.read_lines(spark, path, recursiveFileLookup="true")

    assert sorted(r.value for r in read(names).collect()) == ['{"a": 1}', '{"a": 2}']
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read([names[1]])
    with pytest.raises(ValueError, match="pattern characters"):
        read(["a*"])


def test_load_many_files_in_one_job(spark, tmp_path):
    root, out = tmp_path / "raw", str(tmp_path / "loaded")
    a = landing_file(root, "007", "Observation", [{"a": 1}])
    b = landing_file(root, "010", "MedicationOrder", [{"a": 2}], version="r4")
    loaded = tables.load_ndjson(spark, [a, b])
    tables.write_table(loaded, out, layout.LOADED_LEVELS)
    rows = tables.read_tables(spark, out).select("a", *layout.LOADED_LEVELS).collect()
    assert {tuple(r) for r in rows} == {
        (1, "demo", "dstu2", "Observation", "007"),
        (2, "demo", "r4", "MedicationOrder", "010"),
    }
    only = tables.read_tables(spark, out).where("resource_type = 'Observation'")
    assert "PartitionFilters: [isnotnull(resource_type" in (
        only._jdf.queryExecution().executedPlan().toString()
    )


def test_overwrite_replaces_only_touched_partitions(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    tables.write_table(df, out, ["p"])
    tables.write_table(spark.createDataFrame([(3, "x")], "v int, p string"), out, ["p"])
    assert {(r.v, r.p) for r in tables.read_tables(spark, out).collect()} == {(3, "x"), (2, "y")}


def test_scan_of_tables_with_different_columns(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.createDataFrame([(1,)], "a int").write.parquet(one)
    spark.createDataFrame([("x",)], "b string").write.parquet(two)
    rows = tables.read_tables(spark, [one, two]).select("a", "b").collect()
    assert {tuple(r) for r in rows} == {(1, None), (None, "x")}
    declared = T.StructType([T.StructField("a", T.IntegerType())])
    assert tables.read_tables(spark, [one, two], declared).columns == ["a"]


def test_gzip_ndjson_omits_absent_values(spark, tmp_path):
    out = tmp_path / "gz"
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string").coalesce(1)
    tables.write_ndjson(df, str(out), records_per_file=1)
    assert len(list(out.glob("*.json.gz"))) == 2
    assert sorted(r.value for r in spark.read.text(str(out)).collect()) == [
        '{"a":1,"b":"x"}', '{"a":2}',
    ]


def test_paired_paths():
    assert tables.paired("a,b", ["c", "d"]) == [("a", "c"), ("b", "d")]
    with pytest.raises(ValueError, match="2 input paths but 1 output paths"):
        tables.paired("a,b", "c")


def test_spread_only_small_scans(spark):
    assert tables.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 4
    assert tables.spread(spark.range(0, 10, 1, 9)).rdd.getNumPartitions() == 9


NESTED = "id string, meta struct<lastUpdated:string>, xs array<struct<a:bigint>>"


def test_registry_roundtrip(spark, tmp_path):
    root = str(tmp_path / "schemas")
    first = spark.createDataFrame([], NESTED).schema
    registry.write_schemas(spark, root, {("s", "dstu2", "A"): first, ("s", "r4", "A"): first})
    registry.write_schemas(spark, root, {("s", "dstu2", "B"): T.StructType().add("x", "long")})
    schemas = registry.read_schemas(spark, root)
    assert schemas.count() == 3
    assert registry.schema_of(schemas, "A", version="r4") == first
    with pytest.raises(LookupError, match="2 schemas"):
        registry.schema_of(schemas, "A")
    with pytest.raises(LookupError, match="no schemas"):
        registry.schema_of(schemas, "C")
    defs = registry.table_definitions(schemas.where("version = 'dstu2'")).collect()
    assert [(r.model, r.column) for r in sorted(defs, key=lambda r: (r.model, r.position))] == [
        ("A", "id"), ("A", "meta"), ("A", "xs"), ("B", "x"),
    ]
    assert json.loads(next(r.type for r in defs if r.column == "meta"))["type"] == "struct"
    ddl = registry.to_ddl(first)
    assert spark.createDataFrame([], ddl).schema == first


def test_registry_of_named_files(spark, tmp_path):
    schema = T.StructType().add("x", "long")
    (tmp_path / "Observation_schema.json").write_text(json.dumps(json.loads(schema.json()), indent=2))
    (tmp_path / "other.json").write_text("{}")
    schemas = registry.read_schema_files(spark, str(tmp_path))
    assert [r.model for r in schemas.collect()] == ["Observation"]
    assert registry.schema_of(schemas, "Observation") == schema


def test_manifest_last_entry_wins(spark):
    rows = [("u", 1, [("A", "1"), ("B", "2"), ("A", "3")]), ("u", 2, [("B", "4")]), ("v", 1, [])]
    df = spark.createDataFrame(rows, "user string, n int, output array<struct<type:string,url:string>>")
    last = control.flatten_manifest(df, ["user"], "n").collect()
    assert {tuple(r) for r in last} == {("u", "A", "3"), ("u", "B", "4")}
    assert control.flatten_manifest(df, ["user"], "n", keep="all").count() == 4


def test_routing_and_skipping(spark):
    rows = [
        ("a", "dstu2", "Observation", None, "proceed"),
        ("a", "dstu2", "Observation", "skip", "skip"),
        ("b", "dstu2", "Observation", "proceed", "skip"),
        ("a", "r4", "Observation", None, "skip"),
        ("a", None, "Observation", None, "skip"),
        (None, None, None, None, "skip"),
    ]
    names = "source string, version string, model string, status string, wanted string"
    df = spark.createDataFrame(rows, names)
    known = [("a", "dstu2", "Observation"), ("a", "dstu2", "Observation")]
    routed = control.route(df, known).collect()
    assert len(routed) == len(rows) and all(r.status == r.wanted for r in routed)
    assert {r.status for r in control.route(df.drop("status"), []).collect()} == {"skip"}
    status = spark.createDataFrame([("skip",), ("proceed",), (None,)], "status string")
    assert [r.status for r in control.active(status).collect()] == ["proceed", None]
    assert control.active(status.where("status = 'skip'")).count() == 0


def test_partitions_of_a_write_are_open_at_once(spark, tmp_path):
    """Rows keep their order: nothing is sorted; beyond the limit of open files all rows come too."""
    limit = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
    assert limit >= 15
    few, many = (spark.range(400, numPartitions=2).withColumn("p", F.col("id") % n) for n in (3, limit + 20))
    for df, name in ((few, "few"), (many, "many")):
        tables.write_table(df, f"{tmp_path}/{name}", ["p"])
        back = tables.read_tables(spark, f"{tmp_path}/{name}").select("id", F.col("p").cast("bigint"))
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_record_files_are_compressed(spark, tmp_path):
    spark.range(60).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(60).select(
        F.col("id").alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_linenumber"), F.col("id").alias("l_suppkey"),
        F.lit("2024-01-01").cast("date").alias("l_shipdate"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60).select(
        F.col("id").alias("doc_id"), F.lit("web").alias("source"), F.lit("en").alias("lang")
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(60).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("2024-01-01").cast("date").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.lit("F").alias("o_orderstatus"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    root = fixtures.write_record_files(spark, str(tmp_path))
    lines = spark.read.text(root, recursiveFileLookup=True).withColumn("file", F.input_file_name())
    assert lines.count() == 241
    assert lines.where(~F.col("file").endswith(".gz")).count() == 0
