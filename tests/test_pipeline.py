import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import compare, duck  # noqa: E402

ROWS_ONLY: set = set()


def test_registry_and_oracles_cover_each_other():
    from tallyrisk.plans.oracle import ORACLE
    from tallyrisk.plans.queries import REGISTRY
    q, o = E.queries(), E.oracle_sql()
    assert set(REGISTRY) - set(ORACLE) == ROWS_ONLY
    assert set(REGISTRY) <= set(q) and set(o) <= set(q)


def test_entry_smoke(spark):
    df = E.entry(spark)
    n = df.count()
    assert n > 0
    assert "total_invoice" in df.columns and "risk_balance" in df.columns


@pytest.mark.parametrize("name", ["pair_metrics", "pair_score", "predict_pair_10d", "supplier_pair_score",
                                  "agg_customer_score", "ndg_score", "override_supplier", "cross_name_means",
                                  "extract_chargebacks", "constants_upsert"])
def test_oracle_small(spark, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck(SF_SMALL).execute(E.oracle_sql()[name]).df()
    ok, msg = compare(sdf, odf)
    assert ok, msg


def test_score_invariants(spark):
    s = E.queries()["pair_score"](spark, SF_SMALL).toPandas()
    assert ((s.score >= 0) & (s.score <= 800)).all()
    lv = s.apply(lambda r: 1 if r.score <= 250 else 2 if r.score <= 400 else 3, axis=1)
    assert (lv == s.level).all()


def test_predictions_non_negative(spark):
    p = E.queries()["predict_pair_30d"](spark, SF_SMALL).toPandas()
    assert (p.predict_ar_30d >= 0).all()


def test_ratios_sum_to_100_or_0(spark):
    r = E.queries()["ratio_rescale"](spark, SF_SMALL).toPandas()
    s = r.payment_timeliness_ratio + r.late_payment_ratio_lt10 + r.late_payment_ratio_gt10
    # the query rounds each ratio to 6 places, so the sum may be off by a few 1e-6
    assert all(math.isclose(v, 100, abs_tol=1e-5) or math.isclose(v, 0, abs_tol=1e-9) for v in s)


def test_pca_weights_signs(spark):
    w = {r.metric: r.weight for r in E.queries()["supplier_pca_weights"](spark, SF_SMALL).collect()}
    assert w["open_payable"] <= 0 and w["total_invoice"] >= 0 and len(w) == 10


def test_stages_are_compressed_columns(spark):
    """A stage is read back by column, with the size of its files known; nulls, dates and names stay."""
    from tallyrisk.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    rows = spark.range(50_000).selectExpr("id", "cast(id % 7 AS double) AS x", "'a name that comes again' AS name",
                                          "if(id = 3, null, date'2001-08-01') AS day", "cast(null AS string) AS none")
    kept = t.stage("kept", lambda: rows)
    assert kept.dtypes == rows.dtypes and kept.count() == 50_000 and kept.exceptAll(rows).count() == 0
    assert int(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 50_000 * 20
    assert "ReadSchema: struct<x:double>" in kept.select("x")._jdf.queryExecution().executedPlan().toString()
    assert t.stage("kept", lambda: rows.limit(1)) is kept
