"""P1-P3, P8, P10, P11 on hand-made values (FIXTURES.md §4)."""
import math

from pyspark.sql import functions as F

from kassa.functions.clean import (clip_at_zero, coerce_numeric, normalise_identifier, parse_yyyymmdd,
                                   safe_ratio, truthy)


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def _out(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_normalise_identifier(spark):
    df = _col(spark, [" A1 ", "NA", "null", "None", "", None, "nan ", "\tB2 ", "Nonesuch"])
    assert _out(df, normalise_identifier("v")) == ["A1", "", "", "", "", "", "", "B2", "Nonesuch"]


def test_coerce_numeric(spark):
    df = _col(spark, ["1 234,50", "1 000", "12.5", "1,234.56", "abc", "1.0d", "NaN", None, "inf", "-1e3",
                      "1 000"])
    got = _out(df, coerce_numeric("v"))
    assert got[:8] == [1234.5, 1000.0, 12.5, None, None, None, None, None]
    assert math.isinf(got[8]) and got[8] > 0
    assert got[9] == -1000.0 and got[10] == 1000.0


def test_parse_dates(spark):
    df = _col(spark, ["20230105", "20230132", "2023-01-05", "", None, "2023105", " 20240229 "])
    got = [str(x) if x else None for x in _out(df, parse_yyyymmdd("v"))]
    assert got == ["2023-01-05", None, None, None, None, None, "2024-02-29"]


def test_truthy(spark):
    df = _col(spark, ["1", "Yes", " TRUE ", "0", "1.0", None, "y", "no"])
    assert _out(df, truthy("v")) == [True, True, True, False, False, False, True, False]


def test_ratio_and_clip(spark):
    df = spark.createDataFrame([(0, 10.0, 2.0), (1, 1.0, 0.0), (2, None, 1.0), (3, -3.0, None)],
                               "i int, a double, b double")
    assert _out(df, safe_ratio("a", "b")) == [5.0, None, None, None]
    assert _out(df, clip_at_zero("a")) == [10.0, 1.0, None, 0.0]
    assert _out(df, F.col("a")) == [10.0, 1.0, None, -3.0]
