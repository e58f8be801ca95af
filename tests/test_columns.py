import datetime as dt

import pytest
from pyspark.sql import functions as F

from statmart.functions import paths
from statmart.functions.columns import (cast_columns, null_tokens, null_tokens_all, pad_code,
                                        parse_date, parse_decimal_comma, period_year,
                                        round_to_int64, substr_from, to_int64, trim_all,
                                        year_in_name)
from statmart.functions.names import (assign_columns, clean_name, clean_name_col,
                                      dimension_alias, lower_columns, topic_alias)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_trim_removes_all_unicode_white_space(spark):
    assert one(spark, trim_all("v"), "\t x  \n") == "x"
    assert one(spark, F.trim("v"), "\t x ") == "\t x"          # Spark's trim keeps the tab


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.5,), (1.49,), (None,)], "v double")
    got = [r[0] for r in df.select(round_to_int64("v")).collect()]
    assert got == [3, -3, 1, 1, None]
    # plain cast truncates: the reason for the rounding step
    assert df.select(F.col("v").cast("bigint")).first()[0] == 2


def test_text_to_int64_strict_and_lenient(spark):
    assert one(spark, to_int64("v"), "2018") == 2018
    assert one(spark, to_int64("v", lenient=True), "5,0") is None
    with pytest.raises(Exception) as e:
        spark.createDataFrame([("x1",)], "v string").select(to_int64("v")).collect()
    assert "CAST_INVALID_INPUT" in str(e.value)


def test_period_year_and_substr(spark):
    assert one(spark, period_year("v"), "2018JJ00") == 2018
    assert one(spark, substr_from("v", 7), "Type: Paar") == "Paar"


def test_null_tokens(spark):
    df = spark.createDataFrame([(".",), ("        .",), ("        .       ",), ("3",), (None,)], "v string")
    assert [r[0] for r in df.select(null_tokens("v")).collect()] == [None, None, None, "3", None]
    typed = cast_columns(null_tokens_all(df), {"v": "double"})
    assert [r[0] for r in typed.collect()] == [None, None, None, 3.0, None]


def test_pad_code_never_cuts(spark):
    assert one(spark, pad_code("v"), "1012020") == "01012020"
    assert one(spark, pad_code("v"), "123456789") == "123456789"


@pytest.mark.parametrize("text,expected", [
    ("1012020", dt.datetime(2020, 1, 1)),
    ("01012020", dt.datetime(2020, 1, 1)),
    ("00000000", None),
    ("31022020", None),
    ("", None),
    ("   ", None),
    (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, parse_date("v"), text) == expected


def test_year_in_name(spark):
    assert one(spark, year_in_name("v"), "open data 2018 - gemeente.csv") == 2018
    assert one(spark, year_in_name("v"), "no year.csv") is None


def test_decimal_comma(spark):
    assert one(spark, parse_decimal_comma("v"), "5,0") == 5.0
    assert one(spark, parse_decimal_comma("v"), "x") is None


def test_name_rules():
    assert clean_name(" a-b.c(d)%e ") == "a_b_c_d__e"
    assert clean_name("a b", extra_chars=" ") == "a_b"
    assert dimension_alias("Regio S") == "regio_s"
    assert topic_alias("Gemiddeld inkomen (x 1 000 euro), %") == "gemiddeld_inkomen_x_1_000_euro_per"


def test_clean_name_column_matches_python(spark):
    names = [" a-b.c(d)%e ", "plain", "x.y.z"]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    assert [r[0] for r in df.select(clean_name_col("v")).collect()] == [clean_name(n) for n in names]


def test_lower_and_assign_columns(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert lower_columns(df).columns == ["a", "b"]
    assert assign_columns(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        lower_columns(spark.createDataFrame([(1, 2)], "A int, a int"))
    with pytest.raises(ValueError):
        assign_columns(df, ["x"])


@pytest.mark.parametrize("path,name,stem,suffix,parent,tid", [
    ("a/b/c.csv", "c.csv", "c", ".csv", "a/b", "c"),
    ("a/b/x.y.parquet", "x.y.parquet", "x.y", ".parquet", "a/b", "y"),
    ("a/.bashrc", ".bashrc", ".bashrc", "", "a", ""),
    ("file", "file", "file", "", ".", None),
])
def test_path_parts(spark, path, name, stem, suffix, parent, tid):
    df = spark.createDataFrame([(path,)], "p string")
    r = df.select(paths.name("p"), paths.stem("p"), paths.suffix("p"), paths.parent("p"),
                  paths.table_id("p")).first()
    assert tuple(r) == (name, stem, suffix, parent, tid)


def test_relative_and_with_suffix(spark):
    df = spark.createDataFrame([("/r/x/y.txt",), ("/other/z.txt",)], "p string")
    got = df.select(paths.relative_to("p", "/r"), paths.with_suffix("p", ".json")).collect()
    assert [tuple(r) for r in got] == [("x/y.txt", "/r/x/y.json"), (None, "/other/z.json")]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_TEXT = st.text(alphabet=st.sampled_from(list("ab-.()%_ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　xyz")),
                max_size=12)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names=st.lists(_TEXT, min_size=1, max_size=20))
def test_clean_name_column_equals_python_form(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "v string")
    assert [r[0] for r in df.select(clean_name_col("v")).collect()] == [clean_name(n) for n in names]


def test_padding_never_shortens(spark):
    from statmart.functions.columns import pad_code, pad_right
    df = spark.createDataFrame([("7",), ("1234",), ("10000",), (None,)], "c string")
    got = [tuple(r) for r in df.select(pad_code("c", 4), pad_right("c", 4)).collect()]
    assert got == [("0007", "7   "), ("1234", "1234"), ("10000", "10000"), (None, None)]


def test_codes_past_their_old_widths(spark, tmp_path):
    """Keys of more digits than a code is padded to stay apart."""
    from pyspark.sql import functions as F
    from statmart.plans.suite import QUERIES
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    c.withColumn("c_custkey", F.col("c_custkey") + 1_234_567_000).write.parquet(str(tmp_path / "customer.parquet"))
    out = QUERIES["cbs_district_mart"](spark, str(tmp_path))
    wanted = c.where(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")).count()
    assert out.count() == out.select("wijk_code").distinct().count() == wanted
