"""Scalar expressions on literal edge cases (hand-computed expectations)."""

from pyspark.sql import functions as F

from churnlens.functions import band, binarize, cut_index, cut_label, pct, round_half_even, to_number
from churnlens.functions import trunc_int


def col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_to_number_coercion(spark):
    vals = ["29.85", " ", "", "abc", "12d", "NaN", "1e3", " 5 ", None]
    got = [r[0] for r in col(spark, vals, "string").select(to_number("x")).collect()]
    assert got == [29.85, None, None, None, None, None, 1000.0, 5.0, None]


def test_binarize_label_and_service_flag(spark):
    got = [r[0] for r in col(spark, ["Yes", "No", None, "No internet service"], "string")
           .select(binarize("x")).collect()]
    assert got == [1, 0, 0, 0]


def test_right_closed_bins(spark):
    edges = [0, 12, 24, 36, 48, 60, 72]
    df = col(spark, [0, 1, 12, 13, 72, 73], "int").select(cut_index("x", edges).alias("b"))
    assert [r[0] for r in df.collect()] == [None, 1, 1, 2, 6, None]
    lab = df.select(cut_label("b", ["a", "b", "c", "d", "e", "f"])).collect()
    assert [r[0] for r in lab] == [None, "a", "a", "b", "f", None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.5, 0.125)], "a double, b double")
    r = df.select(round_half_even("a", 0), round_half_even("b", 2), pct(F.lit(0.4044), 1)).first()
    assert (r[0], r[1], r[2]) == (2.0, 0.12, 40.4)


def test_band_strict(spark):
    got = [r[0] for r in col(spark, [20.0, 20.1, 40.0, 40.1], "double")
           .select(band("x", [(40, "High"), (20, "Medium")], "Low")).collect()]
    assert got == ["Low", "Medium", "Medium", "High"]


def test_truncation(spark):
    r = spark.range(1).select(trunc_int(F.lit(425.0) * (F.lit(0.418) - F.lit(0.146)))).first()[0]
    assert r == int(425 * (0.418 - 0.146)) == 115
