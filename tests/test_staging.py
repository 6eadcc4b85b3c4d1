import datetime
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions import times
from recordlake.operators.staging import stage
from recordlake.plans.specs import (
    CLINICAL_IMPRESSION,
    IMMUNIZATION,
    MEDICATION_ORDER,
    OBSERVATION,
    STAGING,
)

AS_OF = "2024-01-02 03:04:05.006"


def moment(*parts):
    return datetime.datetime(*parts)


def test_unparseable_text_is_null_also_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.006Z",), ("2024-01-02T03:04:05Z",), ("2024-01-02",), ("x",), (None,)],
        "t string",
    )
    got = df.select(times.parse_timestamp(F.col("t"), times.MILLIS_Z, times.DATE_ONLY).cast("string"))
    assert [r[0] for r in got.collect()] == [
        "2024-01-02 03:04:05.006", None, "2024-01-02 00:00:00", None, None,
    ]


def test_shape_test_never_changes_a_result(spark):
    rng = random.Random(7)
    seeds = ["2024-01-02T03:04:05.006Z", "2024-01-02T03:04:05Z", "2024-01-02", "+12024-01-02",
             "-2024-01-02", "+2024-01-02",
             "2024-1-2", "2024-01-02t03:04:05.006z", "2024-01-02T03:04:05.0061Z",
             "2024-01-02T03:04:05.01Z", " 2024-01-02", "2024-01-02 ", "2024-13-01", "20240102"]
    texts = list(seeds)
    for seed in itertools.islice(itertools.cycle(seeds), 3000):
        chars = list(seed)
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", *"0129-:.TZtz+ \n"])
        texts.append("".join(chars))
    texts = [t for t in texts if not re.match(r"[+-]?\d{6}", t)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (times.MILLIS_Z, times.SECONDS_Z, times.DATE_ONLY):
        plain = F.try_to_timestamp("t", F.lit(pattern))
        shaped = times.parse_timestamp(F.col("t"), pattern)
        assert df.where(~plain.eqNullSafe(shaped)).count() == 0
        assert df.where(plain.isNotNull()).count() > 0


def test_absurd_years_are_null(spark):
    df = spark.createDataFrame([("+1202400-01-02",), ("+999999-01-02",)], "t string")
    got = df.select(times.parse_timestamp(F.col("t"), times.MILLIS_Z, times.DATE_ONLY)).collect()
    assert [r[0] for r in got] == [None, None]


def test_late_and_early_years_are_kept(spark):
    texts = ["+123456-01-01", "+294246-12-31", "+294247-01-01", "+294250-06-01", "-0044-03-15"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(F.year(times.parse_timestamp(F.col("t"), times.DATE_ONLY))).collect()
    plain = df.where("t not like '+29425%'").select(
        F.year(F.try_to_timestamp("t", F.lit(times.DATE_ONLY)))
    )
    assert [r[0] for r in got][:2] == [123456, 294246]
    assert [r[0] for r in got][2:4] == [None, None]
    assert got[4][0] == plain.collect()[3][0]


def test_observation(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05Z", "2024-01-02T03:04:05.006Z", "nope")],
        "issued string, effective_date_time string, meta__last_updated string",
    )
    row = stage(df, STAGING[OBSERVATION], participant="007", as_of=AS_OF).first()
    assert row.issued == moment(2024, 1, 2, 3, 4, 5)
    assert row.effective_date_time == moment(2024, 1, 2, 3, 4, 5, 6000)
    assert row.meta__last_updated is None
    assert row.participant_id == "007"
    assert row.medical_last_updated == "2024-01-02T03:04:05.006Z"
    assert [v.asDict() for v in row.reference_range__low] == [
        {"code": None, "system": None, "unit": None, "value": None}
    ]
    assert row.value_quantity__value is None and row.value_string is None


def test_observation_without_columns_is_typed(spark):
    out = stage(spark.range(1), STAGING[OBSERVATION], as_of=AS_OF).schema
    assert out["issued"].dataType == T.TimestampType()
    assert out["value_quantity__value"].dataType == T.DoubleType()
    assert out["value_string"].dataType == T.StringType()
    assert "meta__last_updated" not in out.names
    assert "participant_id" not in out.names


def test_immunization_and_impression_only_touch_present_columns(spark):
    df = spark.createDataFrame([("2024-01-02",)], "date string")
    row = stage(df, STAGING[IMMUNIZATION], as_of=AS_OF).first()
    assert row.asDict() == {"date": moment(2024, 1, 2), "medical_last_updated": "2024-01-02T03:04:05.006Z"}
    assert stage(df, STAGING[CLINICAL_IMPRESSION], as_of=AS_OF).first().date is None


def test_medication_order(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "2024-01-02T00:00:00.000Z")],
        "date_written string, dispense_request__validity_period__start string",
    )
    row = stage(df, STAGING[MEDICATION_ORDER], as_of=AS_OF).first()
    assert row.date_written == moment(2024, 1, 2)
    assert row.dispense_request__validity_period__start is None  # already had a time
    assert row.meta__last_updated == "----"
    assert row.prior_prescription__display == "----"


def test_load_stamp_defaults_to_now(spark):
    stamp = stage(spark.range(1), STAGING[CLINICAL_IMPRESSION]).first().medical_last_updated
    assert datetime.datetime.strptime(stamp, "%Y-%m-%dT%H:%M:%S.%fZ").year >= 2024


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_markers_per_input_equal_staging_each_input_alone(spark, broadcast_bytes):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        has_date, has_prior = rng.random() < 0.5, rng.random() < 0.5
        for j in range(500 if i == 0 else rng.randint(1, 6)):
            rows.append((
                f"in{i}", f"{i}-{j}",
                "2024-01-02" if has_date and rng.random() < 0.7 else None,
                f"p{j}" if has_prior and rng.random() < 0.7 else None,
            ))
    schema = "input string, id string, date_written string, prior_prescription__display string"
    df = spark.createDataFrame(rows, schema)
    out = stage(df, STAGING[MEDICATION_ORDER], as_of=AS_OF, input_id="input",
                broadcast_bytes=broadcast_bytes)
    got = sorted((r.id, r.date_written, r.prior_prescription__display) for r in out.collect())

    wanted = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        any_date, any_prior = any(r[2] for r in mine), any(r[3] for r in mine)
        for r in mine:
            day = "2024-01-02 00:00:00" if r[2] else None
            wanted.append((r[1], day if any_date else "----", r[3] if any_prior else "----"))
    key = lambda t: tuple(str(v) for v in t)
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert out.columns[:4] == df.columns
