from pyspark.sql import functions as F

from tallyrisk.functions.scalar import clamp, clamp_replace, from_units, level_max, level_min, level_of, units


def test_level_bins_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 250.0, 250.5, 400.0, 400.5, 800.0, 800.5]], ["s"])
    got = [r[0] for r in df.select(level_of(F.col("s"))).collect()]
    assert got == [None, 1, 1, 2, 2, 3, 3, None]


def test_level_range(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "l int")
    got = [(r[0], r[1]) for r in df.select(level_min(F.col("l")), level_max(F.col("l"))).collect()]
    assert got == [(0, 250), (251, 400), (401, 800), (None, None)]


def test_clamps_keep_null(spark):
    df = spark.createDataFrame([(-5.0,), (900.0,), (300.0,), (None,)], "s double")
    got = [tuple(r) for r in df.select(clamp(F.col("s")), clamp_replace(F.col("s"))).collect()]
    assert got == [(0.0, 10.0), (800.0, 780.0), (300.0, 300.0), (None, None)]


def test_money_units_exact_and_order_free(spark):
    vals = [0.1, 0.2, 0.3, 12345.6789, -0.0001]
    df = spark.createDataFrame([(v,) for v in vals], ["x"])
    total = df.agg(from_units(F.sum(units("x"))).alias("t")).first()["t"]
    assert total == round(sum(vals), 4)
    rev = spark.createDataFrame([(v,) for v in reversed(vals)], ["x"]).repartition(3)
    assert rev.agg(from_units(F.sum(units("x")))).first()[0] == total
