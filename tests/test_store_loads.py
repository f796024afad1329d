import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_check import compare, duck
from tallyrisk.plans import daily
from tallyrisk.plans.oracle import ORACLE
from tallyrisk.plans.queries import REGISTRY
from tallyrisk.sources import loads
from tallyrisk.sources.store import CommitConflict, Store

D = dt.date(2001, 8, 1)


def _folder(name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir="/tmp")


def test_readers_see_the_state_before_or_after_a_commit(spark):
    s = Store(spark, os.path.join(_folder("store"), "t"))
    with pytest.raises(FileNotFoundError):
        s.current()
    assert s.last_day() is None and s.as_of(D) is None
    s.publish(spark.range(3).toDF("k"), D)
    open_reader = s.current()
    version = s.stage(spark.range(5).toDF("k"), D)
    assert s.current().count() == 3                      # written, not committed
    s.commit(D, version)
    assert s.current().count() == 5 and open_reader.count() == 3
    assert s.history().count() == 5 and s.history().schema["processing_date"].dataType.simpleString() == "date"


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    s = Store(spark, _folder("store"))
    s.publish(spark.range(3).toDF("k"), D)
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        s.publish(bad, D)
    assert s.current().count() == 3 and s.days() == [D]


def test_days_are_independent_and_old_versions_go(spark):
    s = Store(spark, _folder("store"))
    for day, n in ((D, 1), (D + dt.timedelta(1), 2), (D, 3), (D, 4), (D, 0), (D - dt.timedelta(1), 7)):
        s.publish(spark.range(n).toDF("k"), day)
    assert s.current().count() == 2 and s.read(D).count() == 0 and s.history().count() == 9
    assert s.as_of(D).count() == 0 and s.before(D).count() == 7 and s.as_of(dt.date(1999, 1, 1)) is None
    kept = [f for f in os.listdir(f"{s.base}/versions/processing_date={D}")]
    assert len(kept) == 1 and len(s._commits()) == 2
    two = s.stage(spark.range(1).toDF("k"), D), s.stage(spark.range(2).toDF("k"), D)
    s.commit(D, two[0])
    other = Store(spark, s.base)
    other.manifest = lambda m=other.manifest(): {**m, "number": m["number"] - 1}    # read before the other's commit
    with pytest.raises(CommitConflict):
        other.commit(D, two[1])
    assert s.read(D).count() == 1


def test_three_days_each_from_the_state_before(spark, monkeypatch):
    out, days = _folder("daily"), [D + dt.timedelta(i) for i in range(3)]
    given = spark.createDataFrame([(1, "a", 0.1), (2, "a", 0.2)], "customer_id long, reason string, weight double")
    supplier = given.withColumnRenamed("customer_id", "supplier_id")
    seen = []

    def scoring(spark, t, out_dir, p, reasons):
        """A run that adds 1 to the weights of customer 1 and c1 to those of supplier 2."""
        c = reasons["customer"].withColumn("weight", F.col("weight") + F.when(F.col("customer_id") == 1, 1).otherwise(0))
        s = reasons["supplier"].withColumn("weight", F.col("weight") + F.when(F.col("supplier_id") == 2, p.c("c1")).otherwise(0))
        seen.append((p.processing_date, dict(p.constants), {r.customer_id: r.weight for r in reasons["customer"].collect()}))
        for name, df in (("customer_reason", c), ("supplier_reason", s), (daily.CLOCK, spark.range(1))):
            Store(spark, os.path.join(out_dir, name)).publish(df, p.processing_date)
        return {}

    monkeypatch.setattr(daily, "run_scoring", scoring)
    t = {"customer_reason": given, "supplier_reason": supplier}
    for day in days:
        assert daily.run_day(spark, t, out, D + dt.timedelta(1))[0] == day
    assert [round(s[2][1], 6) for s in seen] == [0.1, 1.1, 2.1] and all(s[2][2] == 0.2 for s in seen)
    assert len({s[1]["c1"] for s in seen}) == 3
    state = daily.State(spark, out)
    before = {d: sorted(map(tuple, state.store("supplier_reason").read(d).collect())) for d in days}
    daily.run_day(spark, t, out, D, day=days[1])          # the second day again
    assert seen[3] == seen[1] and state.next_date(D) == days[2] + dt.timedelta(1)
    assert {d: sorted(map(tuple, state.store("supplier_reason").read(d).collect())) for d in days} == before


def test_rejected_rows_keep_file_row_text_and_reasons(spark):
    base = _folder("load")
    lines = ["_idx,ndg_name,ndg_id,customer_id,customer,customer_type,customer_type_id", "0,north,1,10,Ann,retail,1", "1,,,11,,,",
             "2,north,x,12,Bob,retail,one", "3,north,1,,Cy,retail,1", "4,north,1,13", "5,north,1,14,Di,retail,1,more", "6,north,99999999999999999999,15,Ed,retail,1"]
    with open(f"{base}/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    house = loads.Warehouse(spark, f"{base}/house")
    got = house.load("crm_customers", f"{base}/a.csv", D)
    assert (got.rows, got.loaded, got.rejected) == (7, 2, 5)
    assert {r.customer_id for r in house.table("crm_customers").collect()} == {10, 11}
    why = {r.row: list(r.reasons) for r in house.rejects("crm_customers").collect()}
    assert why == {"2": ["ndg_id: x", "customer_type_id: one"], "3": ["customer_id: missing"], "4": ["number of columns"],
                   "5": ["number of columns"], "6": ["ndg_id: 99999999999999999999"]}
    rows = {r.row: r for r in house.rejects("crm_customers").collect()}
    assert rows["4"].text == "4,north,1,13" and rows["3"].file.endswith("a.csv") and rows["3"].load_date == D
    assert house.table("crm_customers").schema == loads.LOADS["crm_customers"].schema


def test_full_loads_replace_append_loads_add_a_day(spark):
    base = _folder("load")
    house = loads.Warehouse(spark, f"{base}/house")
    for name, n in (("cash_balance", 2), ("credit_memo", 3)):
        cols = loads.LOADS[name].schema.names
        with open(f"{base}/{name}", "w") as f:
            f.write("\n".join([",".join(["_idx", *cols])] + [",".join([str(i)] + [""] * len(cols)) for i in range(n)]) + "\n")
    for day in (D, D + dt.timedelta(1), D):
        for name in ("cash_balance", "credit_memo"):
            house.load(name, f"{base}/{name}", day)
    assert house.table("cash_balance").count() == 2 and house.table("credit_memo").count() == 6


def test_the_window_scan_chooses_folders(spark):
    plan = REGISTRY["scan_window_partitioned"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x or "Scan parquet" in x)
    assert "PartitionFilters: [isnotnull(invoice_date" in scan and "2001-08-01" in scan and "Window" not in plan


@pytest.mark.parametrize("name", ["state_two_days", "reason_state_two_days", "load_all", "load_rejects", "scan_window_partitioned", "publish_with_audit",
                                  "pair_lookup", "scan_dimensions"])
def test_rows_equal_their_sql(spark, name):
    ok, msg = compare(REGISTRY[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).execute(ORACLE[name]).df())
    assert ok, msg


def test_sums_of_ids_beyond_a_long(spark):
    """The ids of a large load add up to more than a long: no overflow, the total modulo 2^64."""
    from tallyrisk.plans.queries import _held
    for ids, want in (((5, -7, None), -2), ((2**63 - 1,) * 3, 2**63 - 3), ((2**63 - 1, 1), -2**63), ((2**63 - 1, 2**63 - 1, 2), 0)):
        table = spark.createDataFrame([(i,) for i in ids], "id long").select(
            *[F.col("id") if f.name == "id" else F.lit(None).cast(f.dataType).alias(f.name) for f in loads.LOADS["crm_ndg"].schema])
        row = _held(table, "crm_ndg", "n_table").first()
        assert (row.n_table, row.ids, row.units, row.days) == (len(ids), want, 0, 0)


def test_compressed_exports_load_the_same(spark):
    from tallyrisk.sources import publish
    base = _folder("load")
    src = loads.in_file_order(spark.createDataFrame([(i, f'a,"{i}"\n x') for i in range(50)], "id long, name string"), "crm_ndg")
    publish.export_csv(src, f"{base}/plain")
    publish.export_csv(src, f"{base}/small", compression="gzip")
    assert all(f.endswith(".csv.gz") for f in os.listdir(f"{base}/small") if f.startswith("part-"))
    found = []
    for kind in ("plain", "small"):
        house = loads.Warehouse(spark, f"{base}/house-{kind}")
        done = house.load("crm_ndg", f"{base}/{kind}", D)
        found.append(((done.rows, done.loaded, done.rejected), sorted(map(str, house.table("crm_ndg").collect())), house.rejects("crm_ndg").count()))
    assert found[0] == found[1] and found[0][0][0] > 0
