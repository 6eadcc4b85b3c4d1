from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlake.functions.names import (
    camel_to_snake,
    camel_to_snake_value,
    quoted,
    snake_case,
    snake_case_value,
)


def test_snake_case_golden():
    assert snake_case("HullNumber") == "hull_number"
    assert snake_case("keptByMate") == "kept_by_mate"
    assert snake_case("pierAtGMT") == "pier_at_g_m_t"
    assert snake_case("tide") == "tide"
    assert snake_case("_birthDate") == "birth_date"
    assert snake_case("ÄnderungÖl") == "änderung_öl"


def test_camel_to_snake_golden():
    assert camel_to_snake("userProfile__firstName") == "user_profile__first_name"
    assert camel_to_snake("someHTTPCode") == "some_http_code"
    assert camel_to_snake("a__Bc") == "a___bc"


@given(st.text(alphabet="abzABZ019_-. ", max_size=20))
@settings(max_examples=200)
def test_snake_case_marks_every_capital(text):
    marked = "".join("_" + c.lower() if c.isupper() else c for c in text)
    assert snake_case(text) == marked.lstrip("_")


def test_value_forms_agree_with_name_forms(spark):
    texts = ["HullNumber", "someHTTPCode", "a__Bc", "ÄnderungÖl", "x1Y2Zz", "", "_Abc", "ABC def"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t", snake_case_value(F.col("t")).alias("s"), camel_to_snake_value(F.col("t")).alias("c")
    ).collect()
    for row in rows:
        assert row.s == snake_case(row.t)
        assert row.c == camel_to_snake(row.t)


def test_quoted_survives_odd_names(spark):
    df = spark.createDataFrame([(1,)], "`a.b``c` int")
    assert df.select(F.col(quoted("a.b`c")).alias("x")).first().x == 1
