import json

import pytest
from pyspark.sql import types as T

import recordlake.plans.medical_records as plan_module
import recordlake.plans.stored_chain as chain_module
from recordlake.plans.medical_records import medical_records
from recordlake.plans.specs import IMMUNIZATION, MEDICATION_ORDER, OBSERVATION
from recordlake.session import materialize

AS_OF = "2024-01-02 03:04:05.006"


@pytest.fixture
def schemas(spark):
    return {
        OBSERVATION: T.StructType.fromDDL(
            "resourceType string, id string, issued string, code struct<text:string>,"
            "referenceRange array<struct<low:struct<value:double>,high:struct<value:double>>>,"
            "meta struct<lastUpdated:string>"
        ),
        IMMUNIZATION: T.StructType.fromDDL(
            "resourceType string, id string, date string,"
            "vaccineCode struct<text:string>, meta struct<lastUpdated:string>"
        ),
    }


def write(folder, **files):
    folder.mkdir(parents=True)
    for name, lines in files.items():
        (folder / name).write_text("".join(line + "\n" for line in lines))
    return str(folder)


def observation(id_, **more):
    return json.dumps({"resourceType": OBSERVATION, "id": id_} | more)


def test_files_to_records(spark, tmp_path, schemas):
    ranges = [{"low": None}, {"low": {"value": 2.5}, "high": {"value": 3.5}}]
    paths = {
        OBSERVATION: write(
            tmp_path / "obs/source=s/user_id=007/version=dstu2",
            good=[
                observation("a", code={"text": "bp"}, issued="2024-01-01T00:00:00Z"),
                observation("b", referenceRange=ranges),
                "",
            ],
            bad=[observation("c"), "{"],
        ),
        IMMUNIZATION: write(
            tmp_path / "imm/source=s/user_id=8/version=dstu2",
            one=[json.dumps({"resourceType": IMMUNIZATION, "id": "i", "date": "2024-01-05",
                             "vaccineCode": {"text": "flu"}})],
        ),
    }
    rows = {r.id: r for r in medical_records(spark, paths, schemas, as_of=AS_OF).collect()}
    assert set(rows) == {"a", "b", "i"}
    assert (rows["a"].date, rows["a"].name, rows["a"].participant_id) == ("2024-01-01 00:00:00", "bp", "007")
    # the first range says low is null, and has no key high
    assert rows["b"].lower_bound is None
    assert rows["b"].upper_bound == "3.5"
    assert (rows["i"].date, rows["i"].summary) == ("2024-01-05 00:00:00", "flu")
    assert {r.last_updated for r in rows.values()} == {"2024-01-02T03:04:05.006Z"}


def test_markers_are_decided_per_input(spark, tmp_path):
    """Two participants and a file outside the layout; only the first had a prescription."""
    schema = T.StructType.fromDDL(
        "resourceType string, id string, medicationReference struct<reference:string,display:string>,"
        "priorPrescription struct<display:string>"
    )

    def order(id_, **more):
        return json.dumps({"resourceType": MEDICATION_ORDER, "id": id_} | more)

    ref = {"medicationReference": {"reference": "ref"}}
    prior = {"priorPrescription": {"display": "old"}}
    write(tmp_path / "m/source=s/user_id=1/version=v", one=[order("a", **ref, **prior), order("b", **ref)])
    write(tmp_path / "m/source=s/user_id=2/version=v", one=[order("c", **ref)])
    write(tmp_path / "m/loose", one=[order("d", **ref)])
    paths = {MEDICATION_ORDER: str(tmp_path / "m")}
    rows = medical_records(spark, paths, {MEDICATION_ORDER: schema}, as_of=AS_OF).collect()
    assert {(r.participant_id, r.id, r.summary) for r in rows} == {
        ("1", "a", "old ref ----"),
        ("1", "b", "ref ----"),
        ("2", "c", "---- ref ----"),
        (None, "d", "---- ref ----"),
    }


def test_text_is_read_once_and_parsed_only_as_far_as_needed(spark, tmp_path, schemas, monkeypatch):
    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(plan_module, "materialize", noted)
    for resource_type, variants in ((OBSERVATION, 1), (IMMUNIZATION, 0)):
        plans.clear()
        path = write(tmp_path / resource_type, one=[observation("a")])
        df = medical_records(spark, {resource_type: path}, schemas, as_of=AS_OF)
        (stored,) = plans
        assert stored.count("FileScan text") == 1
        assert stored.count("parseJson(") == variants  # only where written nulls can matter
        assert "Exchange" not in stored and "Python" not in stored
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "from_json(" not in plan
        assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_stored_chain_clusters_rows_once(spark, tmp_path, schemas, monkeypatch):
    plans = {"write_ndjson": [], "write_table": []}
    for name, seen in plans.items():

        def noted(df, *args, write=getattr(chain_module, name), seen=seen, **options):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            write(df, *args, **options)

        monkeypatch.setattr(chain_module, name, noted)
    for user in "1", "2":
        write(tmp_path / f"m/source=s/user_id={user}/version=v/model={OBSERVATION}", one=[observation("a")])
    records = chain_module.medical_records_stored(
        spark, {OBSERVATION: str(tmp_path / "m")}, schemas, str(tmp_path / "chain"), source="s", version="v", as_of=AS_OF
    )
    assert sorted(r.participant_id for r in records.collect()) == ["1", "2"]
    (flat,), (loaded, staged) = plans.values()
    assert flat.count("Exchange") == flat.count("BroadcastExchange") + 1
    for plan in loaded, staged:
        assert plan.count("Exchange") == plan.count("BroadcastExchange")
