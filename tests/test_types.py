from decimal import ROUND_DOWN, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunksink.functions import types as t
from chunksink.functions import words
from chunksink.functions.bson import document
from chunksink.operators.tables import Column, ParquetTable
from chunksink.plans.spec import conform


def one(spark, kind, value, ddl, nullable=False):
    return conform(spark.createDataFrame([(value,)], f"v {ddl}"), {"v": Column(kind, nullable)}).first()[0]


LIMITS = [(t.Int8(), -128, 127), (t.Int16(), -32768, 32767), (t.Int32(), -(2**31), 2**31 - 1), (t.Uint8(), 0, 255), (t.Uint16(), 0, 65535), (t.Uint32(), 0, 2**32 - 1), (t.Uint64(), 0, 2**64 - 1)]


@pytest.mark.parametrize(("kind", "low", "high"), LIMITS)
def test_integer_ranges(spark, kind, low, high):
    rows = spark.createDataFrame([(Decimal(low),), (Decimal(high),)], "v decimal(38,0)")
    assert sorted(int(r[0]) for r in conform(rows, {"v": Column(kind)}).collect()) == [low, high]
    for bad in (low - 1, high + 1):
        with pytest.raises(Exception, match="v: out of range"):
            one(spark, kind, Decimal(bad), "decimal(38,0)")


def test_integer_sources(spark):
    for kind, low, high in LIMITS:
        for ddl, bits in (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)):
            least, most = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
            for v in {max(low, least), min(high, most)}:
                assert int(one(spark, kind, v, ddl)) == v
            for v in {low - 1, high + 1}:
                if least <= v <= most:
                    with pytest.raises(Exception, match="out of range"):
                        one(spark, kind, v, ddl)


def test_other_checks(spark):
    for kind, value, ddl, message in [
        (t.Int32(), 1.5, "double", "not an integer"),
        (t.Double(), float("nan"), "double", "not a number"),
        (t.Binary(3), b"ab", "binary", "expected 3 bytes, got 2"),
        (t.Decimal(4, 2), 100.0, "double", "more than 2 integer digits"),
        (t.List(t.Int8()), [1, None], "array<int>", "v.element must not be null"),
        (t.List(t.Int8()), [1, 300], "array<int>", "v.element: out of range"),
        (t.Int32(), None, "int", "v must not be null"),
    ]:
        with pytest.raises(Exception, match=message):
            one(spark, kind, value, ddl)
    assert one(spark, t.Double(), float("inf"), "double") == float("inf")
    assert one(spark, t.Int32(), 7.0, "double") == 7
    assert one(spark, t.Binary(3), b"abc", "binary") == b"abc"
    assert one(spark, t.List(t.Int8(), nullable=True), [1, None], "array<int>") == [1, None]
    assert one(spark, t.List(t.List(t.String())), [[], ["a"]], "array<array<string>>") == [[], ["a"]]
    assert one(spark, t.List(t.Int8()), None, "array<int>", nullable=True) is None
    for bad in ((39, 0), (5, 5), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            t.Decimal(*bad)
    with pytest.raises(ValueError, match="BROTLI"):
        ParquetTable("x", {}, "BROTLI")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.decimals(-(10**8), 10**8, places=6), min_size=1, max_size=40))
def test_decimals_are_cut(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v decimal(20,6)")
    got = [r.v for r in conform(rows, {"v": Column(t.Decimal(12, 2))}, ("i",)).orderBy("i").collect()]
    assert got == [v.quantize(Decimal("0.01"), ROUND_DOWN) for v in values]


def test_decimal_sources(spark):
    assert [one(spark, t.Decimal(9, 2), v, "double") for v in (-1.239, 0.29, 1e-7, 12345.678)] == [Decimal(x) for x in ("-1.23", "0.29", "0", "12345.67")]
    assert one(spark, t.Decimal(9, 2), "-0.999", "string") == Decimal("-0.99")
    assert one(spark, t.Decimal(38, 0), 5, "int") == 5


def test_sizes(spark):
    schema = {"a": Column(t.Boolean()), "b": Column(t.Int16()), "c": Column(t.Uint64()), "d": Column(t.String(), True), "e": Column(t.List(t.Double(), True), True), "f": Column(t.Decimal(20, 2)), "g": Column(t.Binary())}
    made = ParquetTable("x", schema)
    df = spark.createDataFrame([(True, 1, 2, "é", [1.0, None], Decimal("1.5"), b"xyz"), (False, 1, 2, None, None, Decimal("1.5"), b"")], "a boolean, b int, c int, d string, e array<double>, f decimal(20,2), g binary")
    assert [r[0] for r in made.render(df).select(made.size()).collect()] == [1 + 4 + 8 + 2 + 8 + 9 + 3, 1 + 4 + 8 + 9]


def test_bson():
    assert document({"a": 1}) == bytes.fromhex("0c0000001061000100000000")
    assert document({"hello": "world"}) == b"\x16\x00\x00\x00\x02hello\x00\x06\x00\x00\x00world\x00\x00"
    assert document({"x": [True, None, 2.5, 1 << 40], "y": {}})[-8:] == bytes.fromhex("0379000500000000")[-7:] + b"\x00"


def test_words(spark):
    big = (1 << 126) - 1
    df = spark.createDataFrame([("0x" + f"{7:064x}" + f"{big:064x}" + f"{1 << 200:064x}",)], "d string")
    got = df.select(*(words.as_unsigned(words.word(F.col("d"), k)) for k in range(3))).first()
    assert (got[0], got[1], got[2]) == (7, big, None)


def test_decimals_from_text_are_cut_exactly(spark):
    cases = [
        ("1.9999999999999999999", 38, 0, "1"), ("0.12345678901234567899", 38, 20, "0.12345678901234567899"), ("-0.99", 5, 1, "-0.9"), ("123456789012345678901234567890", 38, 2, "123456789012345678901234567890.00"),
        ("1.5E3", 10, 2, "1500.00"), ("12345e-3", 10, 2, "12.34"), ("-1e-30", 38, 31, "-0.0000000000000000000000000000010"), ("1e-40", 10, 2, "0.00"), (".5", 3, 1, "0.5"), ("7.", 3, 1, "7.0"), ("+0007", 2, 0, "7"),
    ]
    for value, precision, scale, want in cases:
        df = spark.createDataFrame([(value,), (None,)], "v string")
        made = df.select(t.Decimal(precision, scale).convert(F.col("v"), df.schema["v"].dataType, "v").alias("d"))
        assert [None if r.d is None else f"{r.d:f}" for r in made.collect()] == [want, None], value
    doubles = spark.createDataFrame([(1e20, "100000000000000000000"), (123456.789, "123456"), (-2.5e-5, "0")], "v double, want string")
    made = doubles.select("want", t.Decimal(38, 0).convert(F.col("v"), doubles.schema["v"].dataType, "v").alias("d"))
    assert all(f"{r.d:f}" in (r.want, f"-{r.want}") for r in made.collect())
    for bad in ("1000", "1e9", "abc", ""):
        df = spark.createDataFrame([(bad,)], "v string")
        with pytest.raises(Exception):  # noqa: B017
            df.select(t.Decimal(3, 0).convert(F.col("v"), df.schema["v"].dataType, "v")).collect()
