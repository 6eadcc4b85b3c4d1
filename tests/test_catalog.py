"""Tables whose partitions the catalog knows, and what a read of them lists."""

import uuid

import pytest
from pyspark.sql import functions as F

from recordlake.session import together
from recordlake.sources import catalog, registry
from recordlake.sources.tables import write_table

SCHEMA = "id bigint, source string, version string, resource_type string, user_id string"
ODD = ["007", "a b", "x/y=z", "50%", "a+b", "it's"]


def rows(spark, users):
    made = [(i, "s", "v1", "T", user) for i, user in enumerate(users)]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    catalog.define_table(spark, name, rows(spark, []).schema, f"{tmp_path}/it's here")
    return name


def discovered(spark, run):
    counter = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = counter.getCount()
    return run(), counter.getCount() - before


def test_a_read_lists_only_the_levels_asked_for(spark, table):
    users = [f"{i:03d}" for i in range(20)]
    catalog.store(rows(spark, users), table, rebalance=True)
    wanted = lambda: catalog.read_levels(spark, table, user_id=["003", "017"]).collect()
    found, listed = discovered(spark, wanted)
    assert sorted(r.id for r in found) == [3, 17]
    assert listed == 2
    none, listed = discovered(spark, lambda: catalog.read_levels(spark, table, source="q").count())
    assert (none, listed) == (0, 0)


def test_values_with_reserved_characters(spark, table):
    catalog.store(rows(spark, ODD), table)
    assert sorted(r.user_id for r in catalog.partitions(spark, table).collect()) == sorted(ODD)
    for i, user in enumerate(ODD):
        assert [r.id for r in catalog.read_levels(spark, table, user_id=user).collect()] == [i]


def test_a_store_replaces_its_own_partitions_by_column_name(spark, table):
    catalog.store(rows(spark, ["a", "b"]), table)
    changed = rows(spark, ["b", "c"]).select("user_id", "resource_type", "source", "version")
    catalog.store(changed, table)
    got = {(r.user_id, r.id) for r in spark.table(table).collect()}
    assert got == {("a", 0), ("b", None), ("c", None)}
    with pytest.raises(ValueError, match="no columns"):
        catalog.store(rows(spark, ["a"]).withColumn("other", F.lit(1)), table)
    with pytest.raises(ValueError, match="no levels"):
        catalog.read_levels(spark, table, id="1")


def test_files_from_elsewhere_count_once_adopted(spark, tmp_path):
    name, root = f"t_{uuid.uuid4().hex}", f"{tmp_path}/files"
    catalog.define_table(spark, name, rows(spark, []).schema, root)
    write_table(rows(spark, ["a", "b"]), root, catalog.LOADED_LEVELS)
    assert spark.table(name).count() == catalog.partitions(spark, name).count() == 0
    catalog.adopt(spark, name)
    assert spark.table(name).count() == catalog.partitions(spark, name).count() == 2
    # what is there already is not defined anew
    catalog.define_table(spark, name, rows(spark, []).schema, f"{tmp_path}/other")
    assert spark.table(name).count() == 2


def test_tables_from_registered_schemas(spark, tmp_path):
    nested = "id bigint, `of x` array<struct<`a.b`: string>>"
    schemas = {("s", "v1", "A"): spark.createDataFrame([], nested).schema}
    schemas["s", "v1", "B"] = schemas["s", "v2", "B"] = spark.createDataFrame([], "n int").schema
    registry.write_schemas(spark, f"{tmp_path}/schemas", schemas)
    known = registry.read_schemas(spark, f"{tmp_path}/schemas")
    name = f"t_{uuid.uuid4().hex}"
    assert catalog.define_tables(spark, known, {"A": name}, f"{tmp_path}/tables") == [name]
    assert spark.table(name).columns == ["id", "of x", *catalog.LOADED_LEVELS]
    with pytest.raises(LookupError, match="several"):
        catalog.define_tables(spark, known, {"B": "never_made"}, f"{tmp_path}/tables")


def test_steps_run_together_in_order(spark):
    counts = together(spark, [lambda n=n: spark.range(n).count() for n in (3, 1, 2)])
    assert counts == [3, 1, 2]
    assert together(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1 / 0, lambda: 1])
