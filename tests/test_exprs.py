from pyspark.sql import functions as F

from tarmac.functions.exprs import (
    month_name, round_half, safe_divide, weighted_mean_all, weighted_mean_valid,
)


def test_weighted_mean_variants(spark):
    df = spark.createDataFrame([(10, 20.0), (30, None)], "n long, d double")
    row = df.agg(weighted_mean_all("n", "d", 0).alias("a"),
                 weighted_mean_valid("n", "d", 0).alias("b")).first()
    assert (row.a, row.b) == (5.0, 20.0)


def test_weighted_mean_zero_weight_is_null(spark):
    df = spark.createDataFrame([(0, 20.0)], "n long, d double")
    assert df.agg(weighted_mean_all("n", "d")).first()[0] is None


def test_safe_divide_and_rounding(spark):
    row = spark.range(1).select(safe_divide(F.lit(1), F.lit(0)).alias("x"),
                                round_half(F.lit(0.285), 2).alias("r"),
                                round_half(F.lit(2.5), 0).alias("h")).first()
    assert row.x is None and row.r == 0.28 and row.h == 3.0


def test_month_name(spark):
    df = spark.createDataFrame([(11,), (0,), (13,), (None,)], "m int")
    assert [r[0] for r in df.select(month_name("m")).collect()] == ["November", None, None, None]
