import datetime
import random

import pytest
from pyspark.sql import functions as F

from recordlake.operators.keyed import attach
from recordlake.operators.unify import distinct_types, project, unify, unify_mixed
from recordlake.plans.specs import (
    CLINICAL_IMPRESSION,
    IMMUNIZATION,
    OBSERVATION,
    PRIORITY,
    RECORD_COLUMNS,
)

DAY = datetime.datetime(2024, 1, 2, 3, 4, 5, 500000)
BOUND = "array<struct<code:string,system:string,unit:string,value:double>>"
OBSERVED = (
    "participant_id string, id string, resource_type string, issued timestamp, "
    "effective_date_time timestamp, code__text string, "
    f"reference_range__low {BOUND}, reference_range__high {BOUND}, "
    "value_quantity__value double, value_quantity__unit string, "
    "value_codeable_concept__text string, value_string string, "
    "meta__last_updated timestamp, medical_last_updated string"
)
IMMUNE = (
    "participant_id string, id string, resource_type string, date timestamp, "
    "vaccine_code__text string, meta__last_updated timestamp, medical_last_updated string"
)
IMPRESSED = (
    "participant_id string, id string, resource_type string, date timestamp, description string, "
    "summary string, meta__last_updated timestamp, medical_last_updated string"
)


def set_for_test(spark, key, value, request):
    spark.conf.set(key, value)
    request.addfinalizer(lambda: spark.conf.unset(key))


def observed(spark, **values):
    names = [part.split()[0] for part in OBSERVED.replace(BOUND, "x").split(", ")]
    base = dict.fromkeys(names) | {"participant_id": "1", "id": "o", "resource_type": OBSERVATION}
    row = base | values
    return spark.createDataFrame([tuple(row[n] for n in names)], OBSERVED)


def test_observation_summary_cascade(spark):
    both = {"value_quantity__value": 1.5, "value_quantity__unit": "mg"}
    more = {"value_codeable_concept__text": "coded", "value_string": "free"}
    cases = [
        (both | more, "1.5 mg"),
        ({"value_quantity__value": 1.5} | more, "coded"),
        ({"value_quantity__unit": "mg", "value_string": "free"}, "free"),
        ({}, None),
    ]
    for values, summary in cases:
        assert project(observed(spark, **values), OBSERVATION).first().summary == summary


def test_observation_bounds_and_dates(spark):
    bound = [("c", "s", "u", 2.0), ("c", "s", "u", 9.0)]
    row = project(
        observed(spark, reference_range__low=bound, reference_range__high=[], effective_date_time=DAY),
        OBSERVATION,
    ).first()
    assert row.lower_bound == "2.0"
    assert row.upper_bound is None  # an empty list has no first element
    assert row.date == "2024-01-02 03:04:05.5"
    later = DAY.replace(year=2025)
    row = project(observed(spark, issued=later, effective_date_time=DAY), OBSERVATION).first()
    assert row.date == "2025-01-02 03:04:05.5"


def test_unify_columns_order_and_duplicates(spark):
    immune = spark.createDataFrame([("1", "i", IMMUNIZATION, DAY, "flu", DAY, "now")] * 2, IMMUNE)
    impressed = spark.createDataFrame(
        [("2", "c", CLINICAL_IMPRESSION, DAY, None, "s", None, "now"),
         ("2", "d", CLINICAL_IMPRESSION, DAY, None, None, None, "now")], IMPRESSED
    )
    out = unify({IMMUNIZATION: immune, CLINICAL_IMPRESSION: impressed, OBSERVATION: observed(spark)})
    assert tuple(out.columns) == RECORD_COLUMNS
    assert {f.dataType.simpleString() for f in out.schema.fields} == {"string"}
    rows = out.collect()
    assert sorted(r.id for r in rows) == ["c", "d", "i", "i", "o"]
    assert {r.id: r.summary for r in rows} == {"c": "s", "d": "", "i": "flu", "o": None}
    assert distinct_types(out).count() == 3


def test_missing_column_is_an_error(spark):
    immune = spark.createDataFrame([("1", "i", IMMUNIZATION)], "participant_id string, id string, resource_type string")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        unify({IMMUNIZATION: immune})
    with pytest.raises(ValueError, match="nothing to unify"):
        unify({})


def test_mixed_input_equals_one_input_per_type(spark):
    immune = spark.createDataFrame([("1", "i", IMMUNIZATION, DAY, "flu", DAY, "now")], IMMUNE)
    watched = observed(spark, value_string="free")
    mixed = watched.unionByName(immune, allowMissingColumns=True)
    one = unify({OBSERVATION: watched, IMMUNIZATION: immune}).collect()
    assert sorted(unify_mixed(mixed, (OBSERVATION, IMMUNIZATION)).collect()) == sorted(one)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_first_match_equals_brute_force(spark, broadcast_bytes):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        kinds = rng.sample([*PRIORITY, "Patient"], rng.randint(1, 3))
        for j in range(700 if i == 1 else rng.randint(1, 8)):
            rows.append((f"in{i}", f"{i}-{j}", rng.choice(kinds)))
    every = (
        "issued effective_date_time date meta__last_updated description summary code__text "
        "vaccine_code__text value_quantity__unit value_codeable_concept__text value_string "
        "dispense_request__validity_period__start medication_reference__display "
        "prior_prescription__display medication_reference__reference "
        "dispense_request__quantity__unit medical_last_updated participant_id"
    ).split()
    df = spark.createDataFrame(rows, "input string, id string, resource_type string").withColumns(
        {c: F.lit("x") for c in every}
        | {c: F.lit(None).cast(BOUND) for c in ("reference_range__low", "reference_range__high")}
        | {"value_quantity__value": F.lit(1.0)}
    )
    out = unify_mixed(df, mode="first_match", input_id="input", broadcast_bytes=broadcast_bytes)
    first = {}
    for key, _, kind in rows:
        if kind in PRIORITY:
            first[key] = min(first.get(key, 9), PRIORITY.index(kind))
    wanted = [i for key, i, kind in rows if kind in PRIORITY and PRIORITY.index(kind) == first[key]]
    assert sorted(r.id for r in out.collect()) == sorted(wanted)


def test_first_match_needs_an_input_id(spark):
    with pytest.raises(ValueError, match="needs input_id"):
        unify_mixed(observed(spark), (OBSERVATION,), mode="first_match")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_attach_with_a_third_of_rows_on_one_key(spark, broadcast_bytes, request):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 300 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string"))).alias("key"),
        "id",
    )
    keys = df.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("id").alias("top"))
    keys = keys.withColumn("flag", F.col("top") % 2 == 0)
    # without Spark's own small-table broadcast, so that the shuffle is the one tested
    set_for_test(spark, "spark.sql.autoBroadcastJoinThreshold", "-1", request)
    for needed in (F.col("flag"), ~F.col("flag")):
        out = attach(df, keys, "key", needed, broadcast_bytes=broadcast_bytes)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (broadcast_bytes == 0)
        assert out.columns == ["key", "id", "top", "flag"]
        small = keys.where(needed).drop("n_rows").withColumnRenamed("key", "k")
        plain = df.join(small, F.col("key").eqNullSafe(F.col("k")), "left").select(out.columns)
        assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0


def test_attach_joins_nothing_where_no_key_is_needed(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("key"), "id")
    keys = df.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("id").alias("top"))
    out = attach(df, keys.withColumn("flag", F.lit(True)), "key", ~F.col("flag"))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.dtypes == [("key", "bigint"), ("id", "bigint"), ("top", "bigint"), ("flag", "boolean")]
    assert {(r.id, r.top, r.flag) for r in out.collect()} == {(i, None, None) for i in range(10)}
