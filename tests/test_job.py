import dataclasses
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_check import compare, duck
from tallyrisk.params import DEFAULT
from tallyrisk.plans import daily, job
from tallyrisk.plans.oracle import ORACLE
from tallyrisk.plans.pipeline import run_scoring
from tallyrisk.plans.queries import REGISTRY
from tallyrisk.sources.loads import LOADS, Warehouse
from tallyrisk.sources.store import Store
from tallyrisk.sources.tables import Tables

D, DAY = DEFAULT.processing_date, dt.timedelta(days=1)


class Source(Tables):
    """Raw tables whose files seem to change."""

    changed = ""

    def source_version(self, *names):
        return super().source_version(*names) + (self.changed if self.changed in names else "")


def test_a_killed_job_goes_on_and_a_changed_source_reruns_what_depends_on_it(spark, monkeypatch):
    source = Source(spark, SF_SMALL)
    work = job.Job(spark, source, tempfile.mkdtemp(prefix="job-", dir="/tmp"), first_day=D - 30 * DAY)

    def scoring(spark, t, out_dir, p, reasons):
        for name in (daily.CLOCK, "customer_reason", "supplier_reason"):
            df = spark.range(1) if name == daily.CLOCK else t[name]
            Store(spark, f"{out_dir}/{name}").publish(df, p.processing_date)
        return {}

    monkeypatch.setattr(daily, "run_scoring", scoring)
    names = list(LOADS)
    whole = Warehouse.load
    monkeypatch.setattr(Warehouse, "load", lambda self, name, path, day: 1 / 0 if name == names[2] else whole(self, name, path, day))
    with pytest.raises(ZeroDivisionError):
        work.run_day(D)
    assert work.ran == [f"extract {n}" for n in names] + [f"load {n}" for n in names[:2]]
    monkeypatch.setattr(Warehouse, "load", whole)
    first = work.ran
    work = job.Job(spark, source, work.base, first_day=work.first_day)        # a new process knows the folder only
    work.run_day(D)
    assert work.kept == first and work.ran == [f"load {n}" for n in names[2:]] + ["score"]
    work.run_day(D)
    assert work.ran == []
    counts = {n: work.house.table(n).count() for n in names}

    work.run_day(D + DAY)
    assert not work.kept and work.window("credit_memo", D + DAY) == (D + DAY, D + DAY) and work.window("credit_memo", D)[0] == D - 30 * DAY
    before = work.house.store("chargebacks").manifest()
    source.changed = "raw_credit_memos"
    work.run_day(D + DAY)
    assert work.ran == ["extract credit_memo", "load credit_memo", "score"]
    work.run_day(D)
    assert work.ran == ["extract credit_memo", "load credit_memo", "score"] and work.house.store("chargebacks").manifest() == before
    assert {n: work.house.table(n, D).count() for n in names} == counts
    with pytest.raises(FileNotFoundError):
        work.house.table("crm_ndg", D - DAY)
    # results that are gone are made again
    work._stage(D, "extract crm_ndg", "x", lambda: f"{work.base}/nothing", lambda path: True)
    work.run_day(D)
    assert work.ran == ["extract crm_ndg", "load crm_ndg", "score"]


def test_job_publishes_what_a_run_over_the_extractions_publishes(spark):
    work = job.Job(spark, Tables(spark, SF_SMALL), tempfile.mkdtemp(prefix="job-", dir="/tmp"))
    work.run_day(D)
    t = Tables(spark, SF_SMALL)
    start = dataclasses.replace(DEFAULT, processing_date=D).window_start
    for name, (_, rows) in job.EXTRACTS.items():
        schema = LOADS[name].schema
        df = rows(t, start, D)
        t._cache[name] = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    constants = {r.id: r.value for r in daily.State(spark, work.out_dir).constants(D).collect()}
    out = tempfile.mkdtemp(prefix="direct-", dir="/tmp")
    run_scoring(spark, t, out, dataclasses.replace(DEFAULT, constants=constants))
    for name in ("customer_supplier_score", "agg_customer_score", "ndg_score", "historical_pairs", "supplier_customer_detail"):
        a, b = (Store(spark, f"{d}/{name}").current().toPandas() for d in (work.out_dir, out))
        assert len(a) and compare(a, b) == (True, "ok"), name


@pytest.mark.parametrize("name", ["job_loads", "job_pair_metrics", "extract_ndg"])
def test_rows_equal_their_sql(spark, name):
    assert compare(REGISTRY[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).execute(ORACLE[name]).df()) == (True, "ok")
