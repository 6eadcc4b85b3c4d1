import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.explode import explode_flatten
from recordlake.functions.names import camel_to_snake
from recordlake.operators.flatten import flatten

BOAT = {
    "hullNo": "K-17",
    "afloat": True,
    "crew": [{"rank": "cook", "berthNo": 4}, {"rank": "mate", "berthNo": 9}],
    "engine": {"makerName": "Voss", "hours": 812.5, "service": {"dueOn": "2031-05-02"}},
    "logBook": {"entry": [{"text": "calm", "windForce": 2}], "keptBy": "mate"},
    "flags": ["red", "blue"],
}


def only_row(df):
    rows = df.collect()
    assert len(rows) == 1
    return {name: value for name, value in rows[0].asDict().items() if value is not None}


def test_objects_and_lists_of_objects(json_df):
    df = json_df({"Port": {"Pier": "C", "Berth": 12}, "Tides": [{"Level": 4}, {"Level": 1}]})
    assert only_row(flatten(df)) == {"port__pier": "C", "port__berth": 12, "tides__level": [4, 1]}


def test_flat_record(json_df):
    assert only_row(flatten(json_df({"Knots": 7, "Wind": "SW"}))) == {"knots": 7, "wind": "SW"}


def test_whole_record(json_df):
    flat = flatten(json_df(BOAT))
    assert flat.columns == sorted(flat.columns)
    assert only_row(flat) == {
        "afloat": True,
        "crew__berth_no": [4, 9],
        "crew__rank": ["cook", "mate"],
        "engine__hours": 812.5,
        "engine__maker_name": "Voss",
        "engine__service__due_on": "2031-05-02",
        "flags": ["red", "blue"],
        "hull_no": "K-17",
        "log_book__entry__text": ["calm"],
        "log_book__entry__wind_force": [2],
        "log_book__kept_by": "mate",
    }


def test_absent_keys_are_compacted_or_aligned(json_df):
    df = json_df({"x": [{"a": 1}, {"a": 2, "b": "B"}]})
    assert only_row(flatten(df)) == {"x__a": [1, 2], "x__b": ["B"]}
    assert only_row(flatten(df, aligned=True)) == {"x__a": [1, 2], "x__b": [None, "B"]}


def test_empty_values_become_null(json_df):
    df = json_df(
        {"id": 1, "x": [], "y": {}, "z": [{"a": 1}], "w": [1]},
        {"id": 2, "x": ["v"], "y": {"k": 1}, "z": [], "w": []},
    )
    rows = {r.id: r.asDict() for r in flatten(df).collect()}
    assert rows[1] == {"id": 1, "x": None, "y__k": None, "z": None, "z__a": [1], "w": [1]}
    assert rows[2] == {"id": 2, "x": ["v"], "y__k": 1, "z": None, "z__a": None, "w": None}


def test_nothing_below_a_list_is_flattened(json_df):
    df = json_df({"x": [{"inner": {"fooBar": 1}, "more": [{"fooBar": 2}]}, {"more": []}]})
    row = flatten(df).first()
    assert [v.asDict() for v in row.x__inner] == [{"fooBar": 1}]
    assert [[v.asDict() for v in vs] for vs in row.x__more] == [[{"fooBar": 2}], []]


def test_list_of_lists_and_mixed_list_stay(json_df):
    row = flatten(json_df({"m": [[1], [2, 3]], "n": [1, {"a": 2}]})).first()
    assert row.m == [[1], [2, 3]]
    assert [json.loads(v) for v in row.n] == [1, {"a": 2}]


def test_collisions(json_df):
    df = json_df({"Id": "A", "k": 1}, {"id": "b", "k": 2})
    with pytest.raises(ValueError, match="share a column name"):
        flatten(df)
    rows = flatten(df, on_collision="coalesce").collect()
    assert {(r.k, r.id) for r in rows} == {(1, "A"), (2, "b")}

    in_list = json_df({"x": [{"Qty": 1}, {"qty": 2, "Qty": 3}]})
    with pytest.raises(ValueError, match="share a column name"):
        flatten(in_list)
    assert sorted(flatten(in_list, on_collision="coalesce").first().x__qty) == [1, 2, 3]


def test_null_elements(json_df):
    df = json_df({"k": 1, "x": [None, {"a": 1}]}, {"k": 2, "x": [{"a": 2}]})
    skipped = {r.k: r.x__a for r in flatten(df, null_elements="skip").collect()}
    assert skipped == {1: [1], 2: [2]}
    kept = {r.k: r for r in flatten(df).collect()}
    assert kept[1].x == [None, (1,)] and kept[1].x__a is None
    assert kept[2].x is None and kept[2].x__a == [2]


def test_written_nulls_stay_where_the_text_is_known(spark):
    schema = T.StructType.fromDDL("k int, x array<struct<a:int,b:struct<c:string>,d:array<int>>>, p struct<ys:array<struct<`e f`:string>>>")
    texts = [
        '{"k":1,"x":[{"a":null},{"a":2},{"b":{"c":"s"}}]}',
        '{"k":2,"x":[{"a":null}],"p":{"ys":[{"e f":null},{"e f":"v"},{}]}}',
        '{"k":3,"x":[{"d":[]},{"d":null},{"d":[1]}]}',
        '{"k":4,"x":[]}',
        '{"k":5,"x":[{"a":1,"a":7}]}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    parsed = df.select("line", F.from_json("line", schema).alias("r")).select("line", "r.*")
    flat = flatten(parsed, text="line")
    assert flat.columns == ["k", "p__ys", "p__ys__e f", "x", "x__a", "x__b", "x__d"]
    rows = {r.k: r for r in flat.collect()}
    assert rows[1].x__a == [None, 2] and rows[1].x__b == [("s",)]
    assert rows[2].x__a == [None] and rows[2]["p__ys__e f"] == [None, "v"]
    assert rows[3].x__d == [[], None, [1]] and rows[3].x__a is None
    assert rows[4].x__a is None
    assert rows[5].x__a == [7]


def test_only_needed_fields_are_read(json_df, spark, tmp_path):
    json_df(BOAT).write.parquet(str(tmp_path / "p"))
    flat = flatten(spark.read.parquet(str(tmp_path / "p")), null_elements="skip").select(
        "log_book__entry__text"
    )
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<logBook:struct<entry:array<struct<text:string>>>>" in plan


CARGO = {
    "manifestNo": 55,
    "hold": {"deckNo": 2, "load": {"tons": 31, "goodsType": "grain"}},
    "shipper": {"homePort": "Riga"},
}


def test_explode_flatten_names_and_values(json_df):
    row = only_row(explode_flatten(json_df(CARGO), "__", rename=camel_to_snake))
    assert row == {
        "manifest_no": 55,
        "hold__deck_no": 2,
        "hold__load__tons": 31,
        "hold__load__goods_type": "grain",
        "shipper__home_port": "Riga",
    }


def test_explode_flatten_opens_lists_within_lists(json_df):
    df = json_df({"a": [{"b": [{"c": 1}, {"c": 2}], "d": 3}, {"b": [], "d": 4}]})
    rows = sorted((r.a_d, r.a_b_c or 0) for r in explode_flatten(df).collect())
    assert rows == [(3, 1), (3, 2), (4, 0)]


def test_explode_flatten_keeps_case_and_exploded_values(json_df):
    df = json_df({"k": 1, "xs": [{"aB": 1}, {"aB": 2}], "ys": ["p", "q"], "none": []})
    out = explode_flatten(df)
    assert set(out.columns) == {"k", "xs_aB", "ys", "none"}
    rows = {(r.xs_aB, r.ys, r.none) for r in out.collect()}
    assert rows == {(1, "p", None), (1, "q", None), (2, "p", None), (2, "q", None)}


def test_explode_flatten_prefix_is_applied_once(json_df):
    out = explode_flatten(json_df({"a": {"b": {"c": 1}}, "d": 2}), prefix="p_")
    assert set(out.columns) == {"p_a_b_c", "p_d"}


def test_explode_flatten_leaves_flat_records_alone(json_df):
    df = json_df({"someName": 1})
    assert explode_flatten(df, "__", rename=camel_to_snake).columns == ["someName"]


def test_explode_flatten_lists_of_lists(json_df):
    out = explode_flatten(json_df({"m": [[1, 2], [3]]}))
    assert sorted(r.m for r in out.collect()) == [1, 2, 3]


def test_no_python_in_the_plan(json_df):
    plan = flatten(json_df(BOAT))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def ordered(spark, *texts):
    schema = "Id string, id string, sub struct<Code:bigint,code:bigint>, `a b` string, `A b` string"
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df.select("text", F.from_json("text", schema).alias("r")).select("text", "r.*")


def test_the_last_key_of_the_text_wins(spark):
    df = ordered(
        spark,
        '{"Id":"1","id":"2","sub":{"code":1,"Code":2},"a b":"p","A b":"q"}',
        '{"id":"2","Id":"1","sub":{"Code":2,"code":1},"A b":"q","a b":"p"}',
        '{"id":"2","Id":null}',
        '{"Id":"1"}',
        "{}",
    )
    rows = flatten(df, text="text", on_collision="last").collect()
    assert [r.id for r in rows] == ["2", "1", None, "1", None]
    assert [r.sub__code for r in rows] == [2, 1, None, None, None]
    assert [r["a b"] for r in rows] == ["q", "p", None, None, None]


def test_the_last_key_needs_the_text(spark):
    with pytest.raises(ValueError, match="text"):
        flatten(ordered(spark, "{}").drop("text"), on_collision="last")


def test_lists_of_a_text_are_taken_whole_and_made_once(spark):
    schema = T.StructType.fromDDL("id string, items array<struct<qty:double,note:string>>")
    lists = {
        "whole": ([{"qty": 1, "note": "a"}, {"note": "b", "qty": 2.5}], [1.0, 2.5], ["a", "b"]),
        "absent": ([{"qty": 1}, {"note": "b"}, {}], [1.0], ["b"]),
        "written": ([{"qty": None, "note": "a"}, {"qty": 2}], [None, 2.0], ["a"]),
        "other type": ([{"qty": "x", "note": 1.5}, {"qty": 3, "note": "n"}], [None, 3.0], ["1.5", "n"]),
        "none": ([], None, None),
        "empty": ([{}], None, None),
    }
    texts = [(json.dumps({"id": name, "items": x[0]}),) for name, x in lists.items()] + [('{"id":"no"}',)]
    df = spark.createDataFrame(texts, "text string")
    df = df.select("text", F.from_json("text", schema).alias("r")).select("text", "r.*")
    flat = flatten(df, text="text")
    rows = {r.id: (r.items__qty, r.items__note) for r in flat.collect()}
    assert rows == {name: x[1:] for name, x in lists.items()} | {"no": (None, None)}
    # the way that tells an absent key from a written null stands in the plan once a key
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrayType(VariantType") == 2
