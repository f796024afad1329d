import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyrisk.operators import cross_slices, override
from tallyrisk.params import PAIR_METRICS
from tallyrisk.plans import queries as Q
from tallyrisk.sources import exports
from tallyrisk.sources.tables import Tables


def test_positions_number_the_keys_in_order(spark):
    keys = spark.createDataFrame([(k * 7 - 300,) for k in range(500)], "k long").repartition(5)
    assert [r.pos for r in cross_slices.positions(keys, "k").orderBy("k").collect()] == list(range(500))
    assert cross_slices.positions(keys.limit(0), "k").count() == 0


@pytest.mark.parametrize("n_rows, n", [(137, 8), (20, 8), (3, 8), (0, 8), (10, 1)])
def test_slices_end_at_rounded_bounds(spark, n_rows, n):
    rows = spark.createDataFrame([(i,) for i in range(n_rows)] * 2 + [(None,)], "customer_id long")
    got = {r.customer_id: r.slice for r in cross_slices.customer_slices(rows, n).collect()}
    bounds = [round(n_rows * k / n) for k in range(n + 1)]
    assert got == {i: k + 1 for k in range(n) for i in range(bounds[k], bounds[k + 1])}


def test_one_slice_equals_the_whole(spark):
    t = Tables.for_run(spark, SF_SMALL)
    whole = Q.cross_inputs(spark, t)
    one = cross_slices.SlicedCross(whole, cross_slices.customer_slices(t.crm_customers, 1))
    for entity in ("customer", "supplier"):
        a = {r[0]: (r[1], round(r[2], 6)) for r in whole.name_means(entity).select(f"{entity}_id", "n_history", "mean_score").collect()}
        b = {r[0]: (r[1], round(r[2], 6)) for r in one.name_means(entity).select(f"{entity}_id", "n_history", "mean_score").collect()}
        assert a == b and a


def test_slice_without_history_imputes_nothing(spark):
    t = Tables.for_run(spark, SF_SMALL)
    whole = Q.cross_inputs(spark, t)
    held = whole.hist_pairs.select("customer_id").distinct()
    slices = (t.crm_customers.select("customer_id").distinct().join(held.withColumn("h", F.lit(True)), "customer_id", "left")
              .select("customer_id", F.when(F.col("h"), 1).otherwise(2).alias("slice")))
    one = cross_slices.SlicedCross(whole, slices)
    assert one.cents.filter("slice = 2 AND k1_comb IS NULL AND k2_comb IS NULL AND k3_comb IS NULL").count() == 1
    assert one.value_table().filter("slice = 2 AND i_comb IS NOT NULL").count() == 0
    assert one.value_table().filter("slice = 1 AND i_comb IS NOT NULL").count() > 0


def test_export_header_and_values(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "A, \"quoted\" name", 0.1 + 0.2, None, 3)],
                               "customer_id long, supplier_id long, supplier_name string, total_invoice double, late_payment_ratio_gt10 double, level int")
    day = dt.date(2001, 8, 1)
    schema = exports.write_export(df, str(tmp_path), "pair_scores", day)
    lines = open(glob.glob(f"{tmp_path}/Customer_Score/*.csv")[0]).read().splitlines()
    assert lines[0] == ("customer_id,supplier_id,supplier,Total_Invoice,Late_Payment_Ratio_more_10_days,Level,processing_date,is_flagged")
    assert exports.read_export(spark, str(tmp_path), "pair_scores", schema).collect() == exports.with_run_columns(df, "pair_scores", day).collect()
    twice = df.withColumn("supplier", F.lit("x"))
    with pytest.raises(ValueError):
        exports.write_export(twice, str(tmp_path), "pair_scores", day)


def test_weight_columns_are_published_by_metric():
    names = [exports.published_name("w_" + m) for m in PAIR_METRICS]
    assert names[0] == "Total_Invoice" and len(set(names)) == len(names) and not any(n.startswith("w_") for n in names)


def test_override_rescales_by_weights_beyond_the_scored_metrics(spark):
    scores = spark.createDataFrame([(1, 300.0, 2), (2, 500.0, 3)], "customer_id long, score double, level int")
    latest = spark.createDataFrame([(1, 3, "r", 2)], "customer_id long, new_level int, reason string, requested_previous_level int")
    w = spark.createDataFrame([(1, 0.5, 1.5)], "customer_id long, w_a double, w_b double")
    n = spark.createDataFrame([(1, 0.8)], "customer_id long, n_a double")
    reasons = spark.createDataFrame([(1, "r", 0.2)], "customer_id long, reason string, weight double")
    got = {wide: override.apply_overrides(scores, "customer_id", latest, w, n, ["a"], reasons, 0.5, weighted=wide)
           .filter("customer_id = 1").first() for wide in (None, ("a", "b"))}
    interim = round(401 + 0.5 * 141.4213562)
    ext = 0.2 * interim / 300 + 0.0001
    for wide, weight in ((None, 0.5), (("a", "b"), 2.0)):
        total = weight + ext
        assert got[wide].external_factor == pytest.approx(ext / total)
        assert got[wide].score == round((0.8 * 0.5 / total + ext / total + 10) / 20 * (800 - 401) + 401)
