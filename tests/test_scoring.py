import datetime as dt
import statistics

from pyspark.sql import functions as F

from tallyrisk.operators import normalize, override, supplier, weights
from tallyrisk.params import PAIR_FIXED_WEIGHTS, PAIR_METRICS


def test_constant_column_customer_vs_supplier(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (1, 5.0, 3.0), (1, 5.0, 0.0)], ["k", "a", "b"])
    cust = normalize.masked_minmax(df, ["a", "b"], ["k"]).orderBy("b").collect()
    assert [r.n_a for r in cust] == [1.0, 1.0, 1.0]          # constant non-zero -> 1
    assert [r.n_b for r in cust] == [0.0, 0.0, 1.0]          # zero mask, max -> 1
    sup = normalize.masked_minmax(df, ["a", "b"], ["k"], zero_variance_to_zero=True).collect()
    assert {r.n_a for r in sup} == {0.0}                      # supplier variant: constant -> 0


def test_masked_minmax_against_row_by_row_definition(spark):
    """The extremes taken from non-zero raw values equal those of the masked z-scores themselves, a hot group included."""
    rows = [(k, i, float(i * k % 7), None if (i + k) % 9 == 0 else float((i + k) % 5) - 2) for k in (1, 2, 3) for i in range(6)]
    rows += [(4, i, float(i % 3), float(i)) for i in range(200)] + [(5, 0, 3.0, -1.0), (6, 0, 0.0, None)]
    df = spark.createDataFrame(rows, "k int, i int, a double, b double")
    got = {(r.k, r.i): (r.n_a, r.n_b) for r in normalize.masked_minmax(df, ["a", "b"], ["k"]).collect()}
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        for col in (2, 3):
            known = [r[col] for r in group if r[col] is not None]
            mean = statistics.fmean(known) if known else 0
            sd = statistics.stdev(known) if len(set(known)) > 1 else None
            z = [0.0 if r[col] in (0, None) or sd is None else (r[col] - mean) / sd for r in group]
            for r, v in zip(group, z):
                want = 0.0 if r[col] == 0 else (v - min(z) + 0.01) / (max(z) - min(z) + 0.01)
                assert abs(got[k, r[1]][col - 2] - want) < 1e-9


def test_rowwise_z_population_std(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], ["x", "y", "z"])
    df, zs = normalize.rowwise_z(df, "all", ["x", "y", "z"])
    got = df.select(*zs.values()).first()
    sd = (2 / 3) ** 0.5
    assert abs(got[0] + 1 / sd) < 1e-12 and got[1] == 0.0


def test_pearson_degenerate_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], ["x", "y"])
    assert df.agg(weights.pearson("x", "y")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0)], ["x", "y"])
    assert abs(df2.agg(weights.pearson("x", "y")).first()[0] - 0.9933992677987828) < 1e-12


def _pairs(spark, rows):
    cols = ["customer_id"] + list(PAIR_METRICS) + ["risk_balance"]
    return spark.createDataFrame([(c,) + tuple(float(v) for v in vals) + (float(rb),) for c, vals, rb in rows], cols)


def test_fixed_weights_when_risk_not_positive_or_single_supplier(spark):
    vals = list(range(19))
    df = _pairs(spark, [(1, vals, -5), (1, [v + 1 for v in vals], 0), (2, vals, 10)])
    w = {r.customer_id: r for r in weights.customer_weights(df).collect()}
    for m, fw in zip(PAIR_METRICS, PAIR_FIXED_WEIGHTS):
        assert w[1]["w_" + m] == float(fw) and w[2]["w_" + m] == float(fw)


def test_sign_forcing(spark):
    base = [float(i) for i in range(19)]
    rows = [(1, [b * k for b in base], 10 - 3 * k) for k in (1, 2, 3)]   # metrics up, positive risk down
    w = weights.customer_weights(_pairs(spark, rows)).first()
    assert w.w_paid_invoice > 0 and w.w_open_ar < 0 and w.w_unpaid_invoice == 0.0
    assert w.w_late_payment_ratio_lt10 < 0                          # free metric keeps its sign


def test_modal_level_tie_goes_to_lowest(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, 3), (1, 2), (2, 1)], ["s", "level"])
    got = {r.s: r.modal_level for r in supplier.modal_level(df, "s").collect()}
    assert got == {1: 2, 2: 1}


def test_latest_override_and_direction(spark):
    ts = dt.datetime(2024, 1, 1)
    upd = spark.createDataFrame([(1, 1, 3, "Level of trust", ts), (1, 3, 1, "Level of trust", ts + dt.timedelta(1)),
                                 (2, 1, 3, "External references", ts), (9, 1, 2, "Level of trust", ts)],
                                "k long, previous_level int, new_level int, reason string, updated_at timestamp")
    latest = {r.k: r.new_level for r in override.latest_override(upd, "k").collect()}
    assert latest == {1: 1, 2: 3, 9: 2}
    scores = spark.createDataFrame([(1, 500.0, 3), (2, 100.0, 1), (3, 300.0, 2)], "k long, score double, level int")
    w = spark.createDataFrame([(k, 0.5) for k in (1, 2, 3)], "k long, w_m double")
    n = spark.createDataFrame([(k, 0.4) for k in (1, 2, 3)], "k long, n_m double")
    reasons = spark.createDataFrame([(1, "Level of trust", 0.2), (2, "External references", 0.1)],
                                    "k long, reason string, weight double")
    out = {r.k: r for r in override.apply_overrides(scores, "k", override.latest_override(upd, "k"), w, n, ["m"],
                                                    reasons, 0.35).collect()}
    assert out[1].level == 1 and out[1].previous_level == 3 and 0 <= out[1].score <= 250   # moved down
    assert out[2].level == 3 and 401 <= out[2].score <= 800                                 # moved up
    assert out[3].previous_score == -1.0 and out[3].score == 300.0                          # untouched
    assert 9 not in out                                                                      # unknown entity
