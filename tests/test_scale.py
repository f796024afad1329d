"""Hot keys, exact sums and the plans that keep them apart."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import aggregate, extract, metrics, normalize
from tallyrisk.params import DEFAULT, PAIR_METRICS

D = DEFAULT.processing_date


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer and one supplier with a third of all pairs each."""
    i = F.col("id")
    return spark.range(6000).select(
        F.when(i % 3 == 0, 1).otherwise(i % 97 + 2).alias("customer_id"), F.when(i % 3 == 1, 1).otherwise(i % 89 + 2).alias("supplier_id"),
        (i * 37 % 101).cast("double").alias("x"), F.when(i % 5 == 0, 0.0).otherwise((i * 17 % 31).cast("double")).alias("y"))


@pytest.mark.parametrize("key", ["customer_id", "supplier_id"])
def test_hot_groups_are_dealt_and_nothing_changes(spark, skewed, key, monkeypatch):
    def run():
        z = normalize.zscore(skewed, ["x", "y"], [key])
        return sorted(map(tuple, normalize.masked_minmax(z, ["x", "y"], [key]).collect()))

    dealt = run()
    monkeypatch.setattr(normalize, "HOT_SHARE", 2.0)      # no group is hot
    assert run() == dealt and len(dealt) == 6000


def test_no_task_of_the_join_gets_the_hot_group(spark, skewed):
    stats = skewed.groupBy("customer_id").agg(F.avg("x").alias("mu"), F.count(F.lit(1)).alias(normalize.COUNT))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = normalize._attach(skewed, ["customer_id"], stats)
        sizes = sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 6000 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_successor_of_a_hot_transaction(spark):
    rows = [(None if i % 50 == 0 else 1 if i % 3 else i % 20, None if i % 41 == 0 else D + dt.timedelta(i * 7 % 90),
             "Early payment advancement" if i % 4 == 0 else "factoring advance" if i % 4 == 1 else None, float(i)) for i in range(900)]
    pay = spark.createDataFrame(rows, "txn_id long, txn_date date, memo string, amount double")
    got = sorted(map(tuple, extract.next_payment_date(pay).collect()), key=str)
    want = []
    for t, d, m, a in rows:
        later = [x[1] for x in rows if x[0] == t and x[1] is not None and d is not None and x[1] > d] if t is not None else []
        want.append((t, d, m, a, (min(later) if later else None) if m else d))
    assert got == sorted(want, key=str)
    plan = extract.next_payment_date(pay)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and plan.index("Window") < plan.index("Aggregate")     # the window reads distinct days


def test_day_sums_beyond_a_long(spark):
    # 40 invoices of 3e12 paid after 400 days: days x units is 40 * 400 * 3e16 = 4.8e20
    rows = [("inv", 1, 1, str(i), 1, D - dt.timedelta(500), D - dt.timedelta(470), D - dt.timedelta(100), 3e12, -3e12) for i in range(40)]
    led = spark.createDataFrame(rows, "src string, customer_id long, supplier_id long, invoice_num string, ispaid int, invoice_date date, duedate date, "
                                      "txn_date date, invoice_amount double, txn_amount double")
    for name in ("balance", "total_amount", "open_balance", "paid_amount"):
        led = led.withColumn(name, F.lit(0.0))
    for name in ("bill_date", "cb_duedate", "paid_date"):
        led = led.withColumn(name, F.lit(None).cast("date"))
    led = led.withColumns({"ndg_id": F.lit(1).cast("long"), "ndg_name": F.lit("g"), "customer_name": F.lit("c"), "client_name": F.lit("s"),
                           "customer_type_id": F.lit(1), "customer_type": F.lit("t")})
    row = metrics.pair_metrics(led).first()
    assert (row.payment_cycle, row.total_invoice) == (400.0, 1.2e14)


def test_roll_up_does_not_depend_on_the_order_of_rows(spark):
    from conftest import SF_SMALL
    from tallyrisk.plans.queries import REGISTRY
    scored = REGISTRY["pair_metrics"](spark, SF_SMALL).withColumns({c: F.lit(1.0) for c in ("score", "predict_ar_10d", "predict_ar_30d")})
    seen = [sorted(map(tuple, aggregate.aggregate_metrics(scored.repartition(n, F.xxhash64("supplier_id", F.lit(n)))
                                                          .sortWithinPartitions(F.xxhash64("customer_id", "supplier_id", F.lit(n))), "ndg_id").collect()))
            for n in (1, 3, 7)]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 10


def test_wide_statistics_of_small_groups_are_not_shuffled(spark):
    """Rows go to their group before the many statistics are made; only those of large groups are combined first; nothing changes."""
    from tallyrisk.operators import weights
    i = F.col("id")
    rows = spark.range(4000).select(
        F.when(i % 3 == 0, 1).when(i % 1999 == 5, None).otherwise(i % 1500 + 2).alias("customer_id"),
        *[((i * (n + 3)) % (7 + n)).cast("double").alias(m) for n, m in enumerate(sorted({*PAIR_METRICS, "risk_balance"}))])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("risk_balance").alias("s"), F.max("dbt").alias("m")]
    want = {r[0]: tuple(r) for r in rows.groupBy("customer_id").agg(*aggs).collect()}
    got = normalize.grouped(rows, ["customer_id"], aggs).collect()
    assert {r[0]: tuple(r) for r in got} == want and len(got) == len(want) and None in want
    for df in (weights.customer_weights(rows), weights.customer_corr_weights(rows), normalize.zscore(rows, PAIR_METRICS, ["customer_id"]),
               normalize.masked_minmax(rows, PAIR_METRICS, ["customer_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(customer_id" in plan and "REPARTITION_BY_NUM" in plan


def test_invoice_rows_are_shuffled_by_order_only(spark, tmp_path):
    """Without any broadcast the line items meet the customers in their orders; repeated and null keys give the rows of the SQL."""
    import duckdb

    from tallyrisk.sources.fixtures import oracle_text
    from tallyrisk.sources.tables import Tables
    day = dt.datetime(2001, 7, 1)
    rows = {
        "nation": ([(k, f"nation {k}", k % 3) for k in range(12)] + [(None, "none", 0), (4, "again", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, f"s{k}", k % 9, 1.0) for k in range(1, 8)] + [(None, "none", 1, 0.0), (3, "twice", 2, 0.0)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(k, f"c{k}", k % 13, 1.0, ("BUILDING", "HOUSEHOLD", None)[k % 3]) for k in range(1, 20)] + [(5, "twice", None, 0.0, "MACHINERY"),
                     (6, "twice", 2, 0.0, "FURNITURE"), (None, "none", 1, 0.0, "AUTOMOBILE")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(k, None if k % 11 == 0 else k % 23, "OFP"[k % 3], k * 1.25, None if k % 17 == 0 else day + dt.timedelta(k % 40)) for k in range(1, 60)]
                   + [(7, 5, "O", 3.5, day), (None, 2, "O", 1.0, day)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
        "lineitem": ([(None if k % 29 == 0 else k % 64, None if k % 19 == 0 else k % 41, None if k % 31 == 0 else k % 9, k % 7 + 1, 1.0,
                       None if k % 37 == 0 else k * 0.37, 0.05, "NRA"[k % 3]) for k in range(400)] * 2,
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_returnflag string"),
    }
    con = duckdb.connect()
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Tables(spark, str(tmp_path)).invoice_payments
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        got = sorted((tuple(r) for r in df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    want = con.execute(oracle_text("invoice_payments"))
    assert df.columns == [c[0] for c in want.description]
    assert got == sorted(want.fetchall(), key=repr) and len(got) > 400

    def below(i):
        """The plan's lines under line ``i``."""
        depth = plan[i].index("Exchange")
        ends = next((j for j in range(i + 1, len(plan)) if plan[j][:depth].strip(" :")), len(plan))
        return "\n".join(plan[i:ends])

    by = {key: [below(i) for i, x in enumerate(plan) if f"Exchange hashpartitioning({key}#" in x] for key in ("l_orderkey", "o_custkey", "l_suppkey")}
    assert all(len(x) == 1 for x in by.values())        # the window by order and supplier needs no shuffle of its own
    assert "l_orderkey#" not in by["o_custkey"][0] and "o_orderkey#" not in by["l_suppkey"][0]
