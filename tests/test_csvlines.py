import csv
import io

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions import csvlines
from nearkin.sources import items

QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def schema_of(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def parse(spark, lines, names, **options):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    rows = items.parse_lines(df, schema_of(names), **options).orderBy("i").collect()
    return {r["i"]: tuple(r)[1:] for r in rows}


def test_quotes(spark):
    lines = ['7,"one, two",ß,"he said ""no"""', ",,,", '"",x," ",y']
    got = parse(spark, lines, ["p", "q", "r", "s"])
    assert got == {
        0: ("7", "one, two", "ß", 'he said "no"'),
        1: ("", "", "", ""),
        2: ("", "x", " ", "y"),
    }


def test_an_open_quote_takes_the_rest_of_the_line(spark):
    line = 'a,"un closed,c,d'
    assert parse(spark, [line], ["p", "q"]) == {0: ("a", "un closed,c,d")}
    assert parse(spark, [line], ["p", "q", "r"]) == {}
    assert parse(spark, [line], ["p"]) == {0: ("a",)}


def test_data_rows(spark):
    lines = ["a,b,c", "a,b,c,", "a,b,c,d,e", "p,q,r,s", "", ",b,c,d", "P,q,r,s", ","]
    got = parse(spark, lines, ["p", "q", "r", "s"])
    assert got == {
        1: ("a", "b", "c", ""),
        2: ("a", "b", "c", "d"),
        5: ("", "b", "c", "d"),
        6: ("P", "q", "r", "s"),
    }


def test_named_header_and_columns_that_are_kept(spark):
    assert parse(spark, ["id,x", "1,2"], ["value", "x"], header="id") == {1: ("1", "2")}


def test_lines_of_more_than_a_thousand_characters(spark):
    long = "x," * 50_000
    assert parse(spark, [f'"{long}",b'], ["p", "q"]) == {0: (long, "b")}


def test_lines_of_very_many_fields(spark):
    lines = ["a,b" + ",x" * 30_000, "c,d" + "," * 400_000, "e" * 300_000 + ",f", "g" + "," * 400_000 + '"']
    got = parse(spark, lines, ["p", "q"])
    assert got == {0: ("a", "b"), 1: ("c", "d"), 2: ("e" * 300_000, "f"), 3: ("g", "")}


def test_a_quoted_field_of_very_many_commas(spark):
    many = "," * 300_000
    lines = [
        f'"{many}",b', f'a,"x{many}"', f'"""{many}""",b,c', f'"",b{many}', f'"{many}"z,b{many}', f'a,"{many}', f'"{many}',
        '"' + 'x"",' * 100_000 + '",b', f'5" a,6" b{many}',
    ]
    got = parse(spark, lines, ["p", "q"])
    assert got == {
        0: (many, "b"), 1: ("a", f"x{many}"), 2: (f'"{many}"', "b"), 3: ("", "b"), 4: (f'"{many}"z', "b"),
        5: ("a", got[5][1]), 7: ('x",' * 100_000, "b"), 8: ('5" a', '6" b'),
    }
    assert got[5][1].endswith(many)


def test_one_column_read_casts_one_column(spark):
    schema = T.StructType([T.StructField("p", T.StringType())] + [T.StructField(n, T.DoubleType()) for n in "qrs"])
    lines = spark.createDataFrame([("a,1,2,3",)], "value string")
    rows = items.typed(items.parse_lines(lines, schema), schema)
    assert "try_cast" not in rows.select("p")._jdf.queryExecution().optimizedPlan().toString()


def test_the_split_is_not_repeated_by_the_filter(spark):
    df = spark.createDataFrame([("a,b",)], "value string")
    plan = items.parse_lines(df, schema_of(["p", "q"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1


FIELD = st.text(st.characters(exclude_characters="\n\r\x00\x01", exclude_categories=["Cs"]), max_size=12)


@QUICK
@given(st.lists(st.tuples(FIELD, FIELD, FIELD), min_size=1, max_size=20))
def test_round_trip(spark, rows):
    names = ["p", "q", "r"]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, p string, q string, r string")
    lines = df.select("i", csvlines.join_line([F.col(n) for n in names]).alias("value"))
    back = items.parse_lines(lines, schema_of(names), header="\u0001none").orderBy("i").collect()
    assert [tuple(r)[1:] for r in back] == rows


@QUICK
@given(st.lists(st.tuples(FIELD, FIELD), min_size=1, max_size=20))
def test_lines_are_those_of_the_csv_module(spark, rows):
    df = spark.createDataFrame(rows, "p string, q string")
    got = [r[0] for r in df.select(csvlines.join_line([F.col("p"), F.col("q")])).collect()]
    for line, row in zip(got, rows, strict=True):
        assert tuple(next(csv.reader(io.StringIO(line), strict=True), ())) == row
