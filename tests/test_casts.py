import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearkin.functions import casts

QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def python_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return math.nan


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


def floats(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", casts.safe_float(F.col("t")).alias("f")).orderBy("i").collect()
    return [r["f"] for r in rows]


TEXTS = [
    "1.5", " 2 ", "nan", "abc", "", None, "1e3", "1_000", "1__0", "_1", "1_", "1d", "2F", "0x1p3",
    "0x10", ".5", "5.", ".", "+1", "-1e-3", "1e", "inf", "-Infinity", "+nan", "NaN", "infinit",
    "\t8\n", "1 2", "--1", "9" * 400, "1e400", "-1e400", "3,5", "2020-01-01", "1.5.2",
]


def test_safe_float_reads_what_python_reads(spark):
    for text, got in zip(TEXTS, floats(spark, TEXTS), strict=True):
        assert same(got, python_float(text)), text


@QUICK
@given(st.lists(st.text(alphabet="0123456789.eE+-_ xdfn", max_size=8), min_size=1, max_size=60))
def test_safe_float_on_any_text(spark, texts):
    for text, got in zip(texts, floats(spark, texts), strict=True):
        assert same(got, python_float(text)), repr(text)


def test_safe_float_default(spark):
    df = spark.createDataFrame([("x",), ("2",)], "t string")
    assert [r[0] for r in df.select(casts.safe_float(F.col("t"), -1.0)).collect()] == [-1.0, 2.0]


def test_safe_int(spark):
    cases = {
        "1990.9": 1990, "-3.7": -3, "nan": 0, "abc": 0, "inf": 0, "-inf": 0, "": 0,
        "2147483647.9": 2147483647, "2147483648": 0, "-2147483648.9": -2147483648, "-2147483649": 0,
        "1e3": 1000,
    }
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    got = {r["t"]: r["i"] for r in df.select("t", casts.safe_int(F.col("t")).alias("i")).collect()}
    assert got == {**cases, None: 0}


def test_is_finite(spark):
    values = [(1.0,), (math.nan,), (math.inf,), (-math.inf,), (None,)]
    df = spark.createDataFrame(values, "v double")
    expected = [True, False, False, False, False]
    assert [r[0] for r in df.select(casts.is_finite(F.col("v"))).collect()] == expected
    stored = df.select(F.coalesce(casts.has_number(df, "v"), F.lit(False))).collect()
    assert [r[0] for r in stored] == expected


@pytest.mark.parametrize(
    "dtype, values, expected",
    [
        ("int", [1, None], [1.0, math.nan]),
        ("float", [0.5, None], [0.5, math.nan]),
        ("string", ["2.5", "x"], [2.5, math.nan]),
        ("boolean", [True, None], [math.nan, math.nan]),
    ],
)
def test_number_of_any_type(spark, dtype, values, expected):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    got = [r[0] for r in df.select(casts.number(df, "v")).collect()]
    assert all(same(a, b) for a, b in zip(got, expected, strict=True))


def test_whole_number_of_any_type(spark):
    for dtype, values, expected in [
        ("bigint", [5, None, 2**40], [5, 0, 0]),
        ("double", [-2.9, math.nan, None], [-2, 0, 0]),
        ("string", ["1999.0", "", None], [1999, 0, 0]),
    ]:
        df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
        assert [r[0] for r in df.select(casts.whole_number(df, "v")).collect()] == expected


def test_clean_utf8(spark):
    raw = [b"a\xffb\xc3", b"ok\xc3\xa9", b"", b"\xe2\x82", "häß\U0001f600".encode(), None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(raw)], "i int, b binary")
    rows = df.select("i", casts.clean_utf8(F.col("b")).alias("t")).orderBy("i").collect()
    expected = [None if b is None else b.decode("utf-8", "ignore") for b in raw]
    assert [r["t"] for r in rows] == expected


def test_title_fragment_is_literal(spark):
    df = spark.createDataFrame([("a%b",), ("aXb",), ("A_B",), (None,)], "n string")

    def hits(fragment):
        return [r[0] for r in df.filter(casts.contains_fragment(F.col("n"), fragment)).collect()]

    assert hits("%") == ["a%b"]
    assert hits("a_b") == ["A_B"]
    assert hits("xB") == ["aXb"]


def test_known_year(spark):
    df = spark.createDataFrame([(0,), (1990,)], "y int")
    assert [r[0] for r in df.select(casts.known_year(F.col("y"))).collect()] == [None, 1990]
