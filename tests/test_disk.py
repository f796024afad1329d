"""What the scoring queries and the job's loads shuffle and write: rows once, without columns that nothing reads."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyrisk.functions.keys import narrowed
from tallyrisk.operators import aggregate, clean, extract, metrics, normalize, predict
from tallyrisk.params import DEFAULT
from tallyrisk.plans import queries
from tallyrisk.sources.tables import Tables

D = DEFAULT.processing_date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def ledger(spark):
    """Customer 1 has a third of the rows; some rows have no invoice number, names differ within a pair, pair (90, 90) has rows that count for nothing."""
    i = F.col("id")
    day = lambda c: F.date_sub(F.lit(D), c.cast("int"))     # noqa: E731
    led = spark.range(3000).select(
        F.when(i % 7 == 0, "cb").otherwise("inv").alias("src"), F.when(i % 3 == 0, 1).when(i == 2999, 90).otherwise(i % 37 + 2).alias("customer_id"),
        F.when(i == 2999, 90).otherwise(i % 11).alias("supplier_id"),
        F.when((i % 7 == 0) | (i % 13 == 0), None).otherwise(i % 900).alias("invoice_num"),
        F.when((i % 7 == 0) | (i == 2999), 2).otherwise(i % 2).cast("int").alias("ispaid"),
        day(i % 600 + 30).alias("invoice_date"), day(i % 600 - 20).alias("duedate"), day(i % 590).alias("txn_date"),
        (i % 97 * 10.5).alias("invoice_amount"), (i % 89 * -1.25).alias("txn_amount"), F.lit(0.0).alias("balance"), (i % 31 * -2.5).alias("total_amount"),
        (i % 3 * 1.5).alias("open_balance"), (i % 17 * 0.5).alias("paid_amount"), day(i % 500).alias("bill_date"), day(i % 400 - 30).alias("cb_duedate"),
        F.when(i % 5 > 0, day(i % 450)).alias("paid_date"), F.when(i % 4 == 0, -1).otherwise(i % 3).alias("ndg_id"),
        F.when(i % 4 == 0, "None").otherwise(F.concat(F.lit("g"), i % 3)).alias("ndg_name"), F.concat(F.lit("c"), i % 5).alias("customer_name"),
        F.concat(F.lit("s"), i % 2).alias("client_name"), (i % 5).cast("int").alias("customer_type_id"), F.concat(F.lit("t"), i % 2).alias("customer_type"))
    return led.localCheckpoint()


def test_pair_metrics_deal_the_ledger_once(spark, ledger, monkeypatch):
    got = rows(metrics.pair_metrics(ledger))
    for share in (0.0, 2.0):            # all customers are combined first, or none
        monkeypatch.setattr(normalize, "COMBINED_SHARE", share)
        assert rows(metrics.pair_metrics(ledger)) == got
    assert len(got) == ledger.select("customer_id", "supplier_id").distinct().count() - 1     # all pairs but (90, 90)
    want = {r[0]: tuple(r) for r in clean.customer_attributes(ledger).collect()}
    names = {(r[0], r[1]): r[2] for r in ledger.groupBy("customer_id", "supplier_id").agg(F.max("client_name")).collect()}
    for r in metrics.pair_metrics(ledger).select("customer_id", "supplier_id", "supplier_name", *clean.customer_attributes(ledger).columns[1:]).collect():
        assert (r[0], *r[3:]) == want[r[0]] and r[2] == names[r[0], r[1]]
    # only the largest customers' rows are shuffled by invoice; the others' go to their customer, and from there on stay
    few, _ = normalize.dealt(ledger, ["customer_id"])
    text = plan(metrics.pair_aggregate(few.withColumnRenamed("client_name", "supplier_name"), described=metrics.DESCRIPTION))
    assert text.count("REPARTITION_BY_NUM") == 1 and "SortAggregate" not in text
    assert all("supplier_id" not in keys for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text))


def test_predictions_of_open_pairs_roll_up_as_those_of_all(spark, ledger):
    pm = metrics.pair_metrics(ledger).localCheckpoint()
    some = predict.predict_open_pairs(ledger, pm)
    every = predict.predict_pairs(ledger, pm)
    assert 0 < some.count() < every.count() == pm.count()
    joined = pm.join(every, ["customer_id", "supplier_id"])
    for key in ("customer_id", "ndg_id"):
        assert rows(aggregate.aggregate_metrics(predict.stacked_predictions(pm, some), key)) == rows(aggregate.aggregate_metrics(joined, key))
    assert rows(predict.with_predictions(pm.select("customer_id", "supplier_id"), some)) == rows(every)


def test_stages_hold_what_later_steps_read(spark):
    t = Tables.for_run(spark, SF_SMALL)
    for df in (queries.scored_pairs(t), queries._supplier_pair_scores(spark, t), queries.final_cust_scores(t)):
        assert not [c for c in df.columns if c.startswith(("n_", "w_"))]
    queries.cust_pairs(t)
    assert not [k for k, _ in t._stages if k == "cust_pairs"]


def test_narrowed_keeps_every_wanted_row(spark):
    data = spark.range(50000).select(F.when(F.col("id") % 100 == 7, None).otherwise(F.col("id") % 20000).alias("k"), F.col("id").alias("x"))
    wanted = spark.range(20000).filter("id % 50 = 3").select(F.when(F.col("id") == 53, None).otherwise(F.col("id")).alias("w"))
    got = narrowed(data, "k", wanted, "w")
    exact = data.join(wanted, data["k"] == wanted["w"], "left_semi")
    assert rows(got.join(wanted, got["k"] == wanted["w"], "left_semi")) == rows(exact)
    assert exact.count() <= got.count() < exact.count() + 500 and got.filter("k IS NULL").count() == 0
    assert narrowed(data, "k", spark.range(5).filter("id < 0"), "id").count() == 0
    assert narrowed(data, "k", wanted.select(F.col("w").cast("int")), "w").count() == 50000       # another type hashes otherwise


def test_window_of_a_relation_is_whole(spark, tmp_path):
    """An order in and out of the window, null keys and null dates: the window's rows are those of the whole relation, sums by order too."""
    day = dt.datetime(2001, 7, 1)
    made = {
        "nation": ([(k, f"nation {k}", 0) for k in range(5)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, f"s{k}", k % 5, 1.0) for k in range(9)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(k, f"c{k}", k % 5, 1.0, "BUILDING") for k in range(20)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(None if k == 8 else k, k % 20, "OF"[k % 2], k * 1.5, None if k == 9 else day - dt.timedelta(k * 20)) for k in range(1, 200)]
                   + [(3, 5, "O", 3.5, dt.datetime(1990, 1, 1)), (150, 5, "F", 3.5, day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                                                                          "o_orderdate timestamp_ntz"),
        "lineitem": ([(None if k % 29 == 0 else k % 220, k % 41, k % 9, k % 7 + 1, float(k % 20), k * 0.37, 0.05, 0.02, "NRA"[k % 3], "OF"[k % 2]) for k in range(900)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    for name, col in (("invoice_payments", "invoice_date"), ("chargebacks", "bill_date"), ("raw_invoices", "invoice_date")):
        whole = t[name].filter(F.col(col).between(DEFAULT.window_start, D))
        near = t.within(name, DEFAULT.window_start, D)
        assert rows(near.filter(F.col(col).between(DEFAULT.window_start, D))) == rows(whole) and whole.count() > 0
        assert near.count() < t[name].count()


def test_first_lines_with_ties_and_nulls(spark):
    lines = spark.createDataFrame([(1, 10, 1.0), (1, 10, 2.0), (1, 11, 3.0), (2, None, 4.0), (2, 12, 5.0), (None, 1, 6.0), (3, None, 7.0)],
                                  "bm_transaction_id long, id long, amount double")
    got = extract.first_lines(lines)
    assert rows(got) == [(1, 10, 1.0), (1, 10, 2.0), (2, 12, 5.0)] and got.columns == lines.columns
    assert "WindowGroupLimit" in plan(got) and "Join" not in plan(got)


def test_payments_are_narrowed_before_they_are_shuffled(spark):
    """The window's transactions are told to the scans of the line items, below the payments' join with the orders."""
    t = Tables(spark, SF_SMALL)
    text = queries._invoice(t, D, D)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [i for i, x in enumerate(text) if "Filter" in x and "getbit" in x]
    scans = [i for i in at if "* 100000" in text[i] and "l_suppkey" in text[i]]
    assert scans and all("Join" not in text[i] for i in scans)
    assert any("Relation [l_orderkey" in x for i in scans for x in text[i + 1:i + 40])


def test_a_relation_put_in_place_of_another_is_read_whole(spark):
    t = Tables(spark, SF_SMALL)
    own = t["chargebacks"]
    assert t.within("chargebacks", D, D).count() < own.count()
    t._cache["chargebacks"] = own.limit(3)
    assert t.within("chargebacks", D, D) is t._cache["chargebacks"]
