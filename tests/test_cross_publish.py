import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.operators import cross, extract
from tallyrisk.sources import publish


def test_virtual_product_matches_brute_force(spark):
    """Per-entity means over the product, computed from value histograms, equal a brute force over the product."""
    customers = spark.createDataFrame([(c,) for c in range(1, 9)], ["customer_id"])
    suppliers = spark.createDataFrame([(s,) for s in range(1, 5)], ["supplier_id"])
    cs = spark.createDataFrame([(1, 120.0), (2, 300.0), (3, 520.0), (4, 700.0), (5, 240.0)], ["customer_id", "score"])
    ss = spark.createDataFrame([(1, 200.0), (2, 390.0), (3, 610.0)], ["supplier_id", "score"])
    ps = spark.createDataFrame([(1, 1, 150.0), (2, 2, 350.0), (3, 3, 560.0), (4, 3, 780.0), (5, 1, 0.0)],
                               ["customer_id", "supplier_id", "score"])
    ci = cross.CrossInputs(customers, suppliers, cs, ss, ps)
    fast = {r.supplier_id: r.mean_score for r in ci.name_means("supplier").collect()}
    # brute force (test only): materialise the tiny product row by row
    prod = (customers.crossJoin(suppliers).join(ps.withColumnRenamed("score", "combined"),
                                                ["customer_id", "supplier_id"], "left")
            .join(ci.cust.select("customer_id", F.col("val").alias("cv")), "customer_id")
            .join(ci.sup.select("supplier_id", F.col("score").alias("own"), F.col("val").alias("sv")), "supplier_id")
            .crossJoin(ci.one))
    imp = cross.impute(ci.comb0, F.col("cv"), F.col("sv"))
    rows = prod.select("supplier_id", F.when(F.col("combined").isNull(), imp["i_sup"]).otherwise(F.col("own"))
                       .alias("v"))
    slow = {r.supplier_id: r.m for r in rows.groupBy("supplier_id").agg(F.avg("v").alias("m")).collect()}
    assert fast.keys() == slow.keys()
    assert all(abs(fast[k] - slow[k]) < 1e-9 for k in fast)


def test_next_payment_date(spark):
    d = dt.date(2001, 1, 10)
    pay = spark.createDataFrame([(1, d, "Early Payment advance"), (1, d, None), (1, d + dt.timedelta(3), None),
                                 (1, d + dt.timedelta(5), "factoring advance"), (2, d, "factoring advance")],
                                "txn_id long, txn_date date, memo string")
    got = sorted((r.txn_id, r.txn_date, r.memo or "", r.corrected_txn_date)
                 for r in extract.next_payment_date(pay).collect())
    assert (1, d, "Early Payment advance", d + dt.timedelta(3)) in got      # next strictly later date
    assert (1, d + dt.timedelta(5), "factoring advance", None) in got        # none later
    assert (1, d, "", d) in got and (2, d, "factoring advance", None) in got


def test_right_join_with_type_filter_vs_condition(spark):
    snaps = spark.createDataFrame([("S1", 0, 5.0), ("S2", 4, 6.0)], "client_id string, contract_states int, cash_balance double")
    opts = spark.createDataFrame([(0, 1, "a", "A", "AA")], "status_index int, type int, status string, display_name string, status_short string")
    sups = spark.createDataFrame([(1, "S1", "one"), (2, "S2", "two"), (3, "S3", "three")], "id long, quickbooks_id string, name string")
    assert {r.id for r in extract.extract_cash_balance(snaps, opts, sups).collect()} == {1}
    cs = {r.id: r.status for r in extract.extract_contract_status(snaps, opts, sups).collect()}
    assert cs == {1: "a", 2: None, 3: None}


def test_publish_is_idempotent_and_keeps_history(spark):
    base = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], ["k", "v"])
    for day in (dt.date(2001, 7, 31), dt.date(2001, 8, 1), dt.date(2001, 8, 1)):
        publish.publish_with_audit(df, base, day)
    hist = publish.read_history(spark, base)
    counts = {r.processing_date: r["count"] for r in hist.groupBy("processing_date").count().collect()}
    assert counts == {dt.date(2001, 7, 31): 2, dt.date(2001, 8, 1): 2}
    assert publish.derive_processing_date(hist, dt.date(2030, 1, 1)) == dt.date(2001, 8, 2)
    assert publish.read_current(spark, base).count() == 2
    # a rerun with fewer rows, then with none, leaves nothing of the run before
    for n, rows in ((1, df.limit(1)), (0, df.limit(0))):
        publish.publish_with_audit(rows, base, dt.date(2001, 8, 1))
        assert publish.read_current(spark, base).count() == n
        assert publish.read_history(spark, base).filter("processing_date = '2001-08-01'").count() == n
    assert publish.derive_processing_date(None, dt.date(2030, 1, 1)) == dt.date(2029, 12, 31)


def test_csv_positional_and_empty_state_table(spark):
    base = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    df = spark.createDataFrame([(1, "a,b", 2.5, dt.date(2001, 1, 1)), (2, None, None, None)],
                               "id long, name string, x double, d date")
    publish.export_csv(df, os.path.join(base, "out"), renames={"x": "amount"})
    back = publish.load_csv_positional(spark, os.path.join(base, "out"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    schema = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("new_level", T.IntegerType())])
    empty = publish.ensure_table(spark, os.path.join(base, "state"), schema)
    assert empty.count() == 0 and empty.schema == schema
    spark.createDataFrame([(7, 2)], schema).write.mode("append").parquet(os.path.join(base, "state"))
    assert publish.ensure_table(spark, os.path.join(base, "state"), schema).count() == 1


def test_ensure_table_never_overwrites_what_it_cannot_read(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="state-", dir="/tmp"), "state")
    os.makedirs(base)
    with open(os.path.join(base, "part-0.parquet"), "w") as f:
        f.write("damaged")
    schema = T.StructType([T.StructField("customer_id", T.LongType())])
    with pytest.raises(Exception):
        publish.ensure_table(spark, base, schema).collect()
    assert open(os.path.join(base, "part-0.parquet")).read() == "damaged"


def test_loads_replace_and_append_by_date(spark):
    base = tempfile.mkdtemp(prefix="load-", dir="/tmp")
    df = spark.createDataFrame([(1,), (2,)], "k long")
    day = dt.date(2001, 8, 1)
    for path, d in (("a", day), ("a", day + dt.timedelta(1)), ("a", day)):
        publish.append_load(df, os.path.join(base, path), d)
    publish.append_load(df.limit(0), os.path.join(base, "a"), day)
    assert publish.read_partition(spark, os.path.join(base, "a"), "load_date", day).count() == 0
    assert spark.read.parquet(os.path.join(base, "a")).count() == 2
    for n in (2, 1):
        publish.full_refresh(df.limit(n), os.path.join(base, "full"))
        assert spark.read.parquet(os.path.join(base, "full")).count() == n


def test_two_dates_on_one_context_have_their_own_stages(spark):
    import dataclasses

    from conftest import SF_SMALL
    from tallyrisk.params import DEFAULT
    from tallyrisk.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    got = []
    for days in (0, 40):
        p = dataclasses.replace(DEFAULT, processing_date=DEFAULT.processing_date - dt.timedelta(days))
        got.append(t.stage("run", lambda p=p: spark.createDataFrame([(p.processing_date,)], "d date"), p).first().d)
    assert got[0] - got[1] == dt.timedelta(40)


def test_predictions_of_an_invoice_with_mixed_due_dates(spark):
    from tallyrisk.operators import predict
    from tallyrisk.params import DEFAULT
    D = DEFAULT.processing_date
    rows = [(1, 1, "A", 0, D + dt.timedelta(5), 1000.0, None, 0.0), (1, 1, "A", 0, D + dt.timedelta(20), 1000.0, D, 400.0)]
    led = spark.createDataFrame(rows, "customer_id long, supplier_id long, invoice_num string, ispaid int, duedate date, "
                                      "invoice_amount double, txn_date date, txn_amount double")
    pm = spark.createDataFrame([(1, 1, 0.0, 100.0, 0.0, 0.0, 0.0, 0.0)],
                               "customer_id long, supplier_id long, early_payment_perc double, payment1_percent double, payment2_percent double,"
                               "early_payment_days double, delinquent_overdueday_lt10 double, delinquent_overdueday_gt10 double")
    row = predict.predict_pairs(led, pm, (10, 30)).first()
    assert (row.predict_ar_10d, row.predict_ar_30d) == (1000.0, 600.0)
    for h in (10, 30):   # the two forms agree
        one = predict.predict_invoices(led, pm, h).agg(F.sum("predicted_u")).first()[0] / 10_000
        assert one == row[f"predict_ar_{h}d"]


def test_constants_keep_refresh_insert(spark):
    D = dt.date(2001, 8, 1)
    existing = spark.createDataFrame([("c1", 0.9, D), ("c2", 0.8, D - dt.timedelta(3)), ("c2", 0.7, D - dt.timedelta(9)),
                                      ("c3", 0.5, D + dt.timedelta(1))], "id string, value double, processing_date date")
    out = {r.id: (r.value, r.processing_date) for r in
           publish.constants_upsert(existing, {"c1": 0.1, "c2": 0.2, "c3": 0.3, "c4": 0.4}, D).collect()}
    assert out == {"c1": (0.9, D), "c2": (0.2, D), "c3": (0.5, D + dt.timedelta(1)), "c4": (0.4, D)}


def test_lenient_casts_and_constant_draws(spark):
    from tallyrisk.sources.tables import coerce_dates, coerce_ids
    df = spark.createDataFrame([("12", "2001-08-01"), ("x1", "not a date")], ["id", "d"])
    got = coerce_dates(coerce_ids(df, ["id"]), ["d"]).collect()
    assert (got[0].id, got[0].d) == (12, dt.date(2001, 8, 1)) and (got[1].id, got[1].d) == (None, None)
    a, b = publish.draw_constants(dt.date(2001, 8, 1)), publish.draw_constants(dt.date(2001, 8, 1))
    assert a == b and 0 <= a["c1"] < 1 and -1 <= a["c3"] < 1 and len(a) == 5


def test_full_scoring_run_publishes_every_table(spark):
    from conftest import SF_SMALL
    from tallyrisk.plans.pipeline import run_scoring
    from tallyrisk.sources.tables import Tables
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    t = Tables(spark, SF_SMALL)
    paths = run_scoring(spark, t, out, stored_constants=t.raw_constant_values)
    files = {k: paths.pop(k) for k in list(paths) if k.startswith("export_")}
    assert len(paths) == 18 and len(files) == 6
    assert spark.read.option("header", True).csv(files["export_pair_scores"]).count() == publish.read_current(spark, paths["customer_supplier_score"]).count()
    for name, path in paths.items():
        cur = publish.read_current(spark, path)
        assert cur.count() > 0 or name.startswith("invoice_predictions"), name
    assert not {"n_pairs", "score_raw", "w_open_ar"} & set(publish.read_current(spark, paths["customer_supplier_score"]).columns)
    s = publish.read_current(spark, paths["agg_customer_score"])
    assert s.filter("is_flagged = 1").count() > 0
