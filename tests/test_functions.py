import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenkeel.functions import dates, rows, values


@pytest.mark.parametrize(
    "date_format, low, high",
    [
        ("yyyy-mm-dd", "2024-02-28", "2024-02-29"),
        ("yyyymmdd", "20240228", "20240229"),
        ("yyyymmdd HH24:mm:ss", "20240228 00:00:00", "20240229 00:00:00"),
        ("yyyy-mm-dd HH24:mm:ss", "2024-02-28 00:00:00", "2024-02-29 00:00:00"),
    ],
)
def test_day_bounds(date_format, low, high):
    assert dates.day_bounds("2024-02-28", date_format) == (low, high)


def test_unknown_format_is_an_error():
    with pytest.raises(ValueError, match="unsupported date format"):
        dates.format_day("2024-01-15", "dd/mm/yyyy")


def test_relative_day():
    assert dates.relative_day(2, "2024-03-01") == dt.date(2024, 2, 28)
    assert dates.relative_day() == dt.date.today() - dt.timedelta(days=2)


def test_window_keeps_the_text_range_semantics(spark):
    df = spark.createDataFrame(
        [("2024-01-14 23:59:59",), ("2024-01-15",), ("2024-01-15 23:59:59",), ("2024-01-16",), (None,)], "d string"
    )
    kept = df.where(dates.day_window(df, "D", "2024-01-15")).collect()
    assert [r.d for r in kept] == ["2024-01-15", "2024-01-15 23:59:59"]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_window_on_typed_columns_takes_any_format(spark, kind):
    df = spark.sql(
        f"select cast(d as {kind}) as d from values ('2024-01-14 23:59:59'), ('2024-01-15 00:00:00'),"
        " ('2024-01-16 00:00:00') as t(d)"
    )
    for date_format in dates.DATE_FORMATS:
        assert df.where(dates.day_window(df, "d", "2024-01-15", date_format)).count() == 1


def test_window_rejects_unfit_columns(spark):
    df = spark.createDataFrame([(20240115, 1.5)], "d int, x double")
    assert df.where(dates.day_window(df, "d", "2024-01-15", "yyyymmdd")).count() == 1
    with pytest.raises(ValueError, match="does not hold"):
        dates.day_window(df, "d", "2024-01-15", "yyyy-mm-dd")
    with pytest.raises(ValueError, match="not found"):
        dates.day_window(df, "missing", "2024-01-15")


def assert_nan_test_agrees(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    parsed = F.coalesce(F.isnan(F.col("x").try_cast("double")), F.lit(False))
    wrong = df.where(parsed != rows.is_nan_text("x")).collect()
    assert not wrong


def test_nan_spellings(spark):
    texts = ["Alice", "NaN", "nan", " NaN ", "+NaN", "-NaN", "+nan", "-nan", "NAN", "nAn\t", "\x00NaN", "NaNd", "1.5",
             "", " ", "\u000bnan", "\u0085nan", "nan nan", "NaN\n", "\x1fnan\x1f", "Infinity", "-", " NaN", "N"]
    assert_nan_test_agrees(spark, texts)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="NanA+- \t\x00 1.", max_size=6), min_size=200, max_size=300))
def test_nan_test_agrees_with_the_cast(spark, texts):
    assert_nan_test_agrees(spark, texts)


def test_missing_texts_become_empty(spark):
    given_texts = ["Alice", "NaN", "nan", " NaN ", "+NaN", None, "1.5", ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given_texts)], "i int, x string")
    got = [r.x for r in df.select("i", rows.blank_missing("x")).orderBy("i").collect()]
    assert got == ["Alice", "", "", "", "", "", "1.5", ""]


def test_keys(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (None, "B"), (None, None)], "id int, code string")
    keys = df.select(rows.joined_key(["id", "code"]).alias("k")).collect()
    assert [r.k for r in keys] == ["1||A", "2", "B", ""]


def test_text_digest(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b, cast(100 as decimal(10,2)) as c, true as d")
    got = df.select(rows.text_digest(list("abcd")).alias("h")).first().h
    assert got == hashlib.sha256(b"1||||100.00||true").hexdigest()
    empty = df.select(rows.text_digest([]).alias("h"), rows.safe_digest([]).alias("s")).first()
    assert empty.h == empty.s == hashlib.sha256(b"").hexdigest()


def test_safe_digest_separates_what_text_joins(spark):
    df = spark.createDataFrame([("p||q", "r"), ("p", "q||r")], "a string, b string")
    safe = rows.safe_digest([(name, F.col(name)) for name in ("a", "b")])
    hashes = df.select(rows.text_digest(["a", "b"]).alias("t"), safe.alias("s")).collect()
    assert len({r.t for r in hashes}) == 1 and len({r.s for r in hashes}) == 2
    missing = spark.sql("select cast(null as int) as a union all select 0")
    assert missing.select(rows.safe_digest([("a", F.col("a").cast("string"))])).distinct().count() == 2


# left type, left value, right type, right value, do they differ?
CASES = [
    ("int", "1", "bigint", "1", False),
    ("int", "1", "int", "null", True),
    ("int", "null", "bigint", "null", False),
    ("decimal(10,2)", "100.00", "int", "100", False),
    ("decimal(10,2)", "100.01", "int", "100", True),
    ("decimal(38,0)", "1", "decimal(38,20)", "1", False),
    ("decimal(38,0)", "'99999999999999999999999999999999999999'", "decimal(38,10)", "'9999999999999999999999999999.1'", True),
    ("decimal(38,0)", "'12345678901234567890123'", "decimal(38,10)", "'12345678901234567890123.0000000001'", True),
    ("decimal(38,18)", "'12345678901234567.1'", "decimal(38,10)", "'12345678901234567.2'", True),
    ("decimal(38,18)", "'12345678901234567.1'", "decimal(38,10)", "'12345678901234567.1'", False),
    ("decimal(38,18)", "'-12345678901234567.100000000000000001'", "decimal(38,10)", "'-12345678901234567.1'", True),
    ("decimal(38,18)", "'-12345678901234567.1'", "decimal(38,10)", "'-12345678901234567.1'", False),
    ("decimal(38,18)", "'-0.5'", "decimal(38,0)", "'-1'", True),
    ("decimal(38,37)", "'1.0000000000000000000000000000000000001'", "decimal(38,0)", "'1'", True),
    ("decimal(38,37)", "'1'", "decimal(38,0)", "'1'", False),
    ("decimal(38,37)", "'-1.5'", "decimal(38,10)", "'-1.5'", False),
    ("decimal(38,38)", "'0.5'", "decimal(38,18)", "'0.5'", False),
    ("decimal(38,30)", "'7'", "bigint", "7", False),
    ("decimal(38,30)", "'7.000000000000000000000000000001'", "bigint", "7", True),
    ("decimal(38,18)", "null", "decimal(38,10)", "'0'", True),
    ("decimal(38,18)", "null", "decimal(38,10)", "null", False),
    ("double", "double('NaN')", "double", "double('NaN')", False),
    ("double", "-0.0D", "double", "0.0D", False),
    ("float", "1.5", "double", "1.5", False),
    ("double", "1.5", "decimal(5,1)", "1.5", False),
    ("string", "'5'", "int", "5", False),
    ("string", "'05'", "int", "5", False),
    ("string", "'6'", "int", "5", True),
    ("string", "'x'", "int", "5", True),
    ("string", "'x'", "int", "null", True),
    ("string", "null", "int", "null", False),
    ("string", "'true'", "boolean", "true", False),
    ("string", "'2024-01-15'", "date", "date'2024-01-15'", False),
    ("date", "date'2024-01-15'", "timestamp", "timestamp'2024-01-15 00:00:00'", False),
    ("timestamp_ntz", "timestamp_ntz'2024-01-15 00:00:00.000001'", "timestamp_ntz",
     "timestamp_ntz'2024-01-15 00:00:00'", True),
    ("timestamp", "timestamp'2024-01-15 00:00:00.000001'", "timestamp", "timestamp'2024-01-15 00:00:00'", True),
    ("boolean", "true", "int", "1", False),
    ("boolean", "true", "decimal(38,20)", "1", False),
    ("boolean", "false", "double", "0", False),
    ("boolean", "true", "int", "2", True),
    ("boolean", "false", "int", "null", True),
    ("boolean", "true", "string", "'1'", False),
    ("binary", "x'00ff'", "binary", "x'00ff'", False),
    ("binary", "x'00ff'", "binary", "x'00fe'", True),
    ("array<int>", "array(1,null)", "array<int>", "array(1,null)", False),
    ("array<string>", "array('a, b')", "array<string>", "array('a','b')", True),
    ("array<double>", "array(-0.0D)", "array<double>", "array(0.0D)", False),
    ("map<string,int>", "map('a',1,'b',2)", "map<string,int>", "map('b',2,'a',1)", False),
    ("map<string,int>", "map('a',1)", "map<string,int>", "map('a',2)", True),
    ("map<string,int>", "map('a',1)", "map<string,int>", "null", True),
    ("struct<m:map<string,int>>", "named_struct('m', map('a',1,'b',2))", "struct<m:map<string,int>>",
     "named_struct('m', map('b',2,'a',1))", False),
    ("string", "'abc'", "array<int>", "array(1)", True),
    ("string", "repeat('x', 100)", "string", "concat(repeat('x', 99), 'y')", True),
]


@pytest.mark.parametrize("left_type, left, right_type, right, expected", CASES)
def test_differs_and_value_text(spark, left_type, left, right_type, right, expected):
    df = spark.sql(f"select cast({left} as {left_type}) as l, cast({right} as {right_type}) as r")
    own, other = (f.dataType for f in df.schema.fields)
    row = df.select(
        values.differs(F.col("l"), own, F.col("r"), other).alias("d"),
        values.value_text(F.col("l"), own, other).alias("lt"),
        values.value_text(F.col("r"), other, own).alias("rt"),
    ).first()
    assert row.d is expected
    assert (row.lt != row.rt) is expected
