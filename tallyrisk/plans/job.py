"""One resumable job a day: extract from the raw sources, load into the warehouse, score and publish.

Stages: eleven extracts (CSV files), eleven loads, one scoring run.  A stage is recorded in the job's log once its result is written, with a digest of its
inputs: the files behind the raw tables and the window for an extract, the extract for a load, the loaded versions, the parameters and the state
before the day for the scoring run.  A stage is *kept* if it is recorded with the same inputs and its result is still there; otherwise it runs.  So a job
that was killed goes on at the first stage that is not done, and after a change of a source only what depends on it runs again.

Every attempt of an extract writes a folder of its own; loads and published tables are versioned (``Store``), and the log is such a table too.  A
stage that was killed between its result and its record runs again and replaces its own result only.

Append loads take the days since their last load before the day (the first load: from ``first_day``), so days that were missed are caught up and no
row is extracted twice; full loads take the whole dimension.
"""
from __future__ import annotations

import dataclasses
import datetime as _dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import extract as ex
from ..params import DEFAULT, Params
from ..sources import publish
from ..sources.loads import APPEND, LOADS, Warehouse, WarehouseTables, in_file_order
from ..sources.store import Store
from ..sources.tables import Tables
from . import daily

LOG_SCHEMA = "stage string, inputs string, output string"


def _status(t: Tables) -> DataFrame:
    return ex.supplier_status(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)


def _parties(t: Tables) -> DataFrame:
    return ex.vendor_customers(t.raw_vendor_companies, t.raw_companies, t.raw_company_customers, t.raw_customers, t.raw_ndg, t.raw_customer_types)


_STATUS = ("raw_snapshots", "raw_status_options", "raw_suppliers")
_BILLS = ("raw_bills", "raw_bill_lines", "raw_accounts", "raw_bill_payments", "raw_vendor_companies", "raw_companies")
_CUSTOMERS = ("raw_customers", "raw_customer_types", "raw_ndg")
#: load -> the raw tables it is extracted from, and its extraction over a window of days
EXTRACTS: dict[str, tuple[tuple[str, ...], Callable[[Tables, _dt.date, _dt.date], DataFrame]]] = {
    "invoice_payments": (("raw_invoices", "raw_payments", "raw_suppliers", *_CUSTOMERS), lambda t, a, b: ex.extract_invoice(
        t.within("raw_invoices", a, b), t.raw_payments, t.raw_suppliers, t.raw_customers, t.raw_ndg, t.raw_customer_types, a, b)),
    "chargebacks": ((*_BILLS, *_CUSTOMERS, "raw_company_customers", "raw_suppliers", "raw_entities", "raw_bill_metadata"), lambda t, a, b: ex.extract_chargebacks(
        t.raw_bills, t.raw_bill_lines, t.raw_accounts, t.raw_bill_payments, _parties(t), t.raw_suppliers, t.raw_entities, t.raw_bill_metadata, a, b)),
    "open_payable": (("raw_supplier_invoice", *_STATUS), lambda t, a, b: ex.extract_open_payable(t.raw_supplier_invoice, _status(t), a, b)),
    "other_open_payables": ((*_BILLS, *_STATUS), lambda t, a, b: ex.extract_other_open_payables(
        t.raw_bills, t.raw_bill_lines, t.raw_accounts, t.raw_bill_payments, ex.vendor_companies(t.raw_vendor_companies, t.raw_companies),
        t.raw_suppliers, _status(t), a, b)),
    "credit_memo": (("raw_credit_memos", *_STATUS), lambda t, a, b: ex.extract_credit_memo(t.raw_credit_memos, _status(t), a, b)),
    "unapplied_balance": (("raw_supplier_invoice", *_STATUS), lambda t, a, b: ex.extract_unapplied_balance(t.raw_supplier_invoice, _status(t), a, b)),
    "cash_balance": (_STATUS, lambda t, a, b: ex.extract_cash_balance(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)),
    "contract_status": (_STATUS, lambda t, a, b: ex.extract_contract_status(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)),
    "crm_classes": (_STATUS, lambda t, a, b: ex.extract_suppliers(t.raw_suppliers, t.raw_snapshots, t.raw_status_options)),
    "crm_customers": (_CUSTOMERS, lambda t, a, b: ex.extract_customers(t.raw_customers, t.raw_customer_types, t.raw_ndg)),
    "crm_ndg": (("raw_ndg",), lambda t, a, b: ex.extract_ndg(t.raw_ndg)),
}
#: input tables of the scoring run that no load fills
OTHER_INPUTS = ("customer_update_level", "supplier_update_level", "override_reasons", "customer_reason", "supplier_reason")


class Job:
    """The job of one folder; ``ran`` and ``kept`` name the stages of the last call."""

    def __init__(self, spark: SparkSession, source: Tables, base: str, p: Params = DEFAULT, first_day: _dt.date | None = None):
        self.spark, self.source, self.base, self.p = spark, source, base.rstrip("/"), p
        self.first_day = first_day
        self.house = Warehouse(spark, f"{self.base}/warehouse")
        self.log = Store(spark, f"{self.base}/log")
        self.out_dir = f"{self.base}/published"
        self.ran: list[str] = []
        self.kept: list[str] = []

    def run_day(self, day: _dt.date, first_constants: DataFrame | None = None) -> None:
        """Bring a day up to date, from the raw tables to the published ones."""
        loaded = self.load_day(day)
        clock = Store(self.spark, f"{self.out_dir}/{daily.CLOCK}")
        state = daily.State(self.spark, self.out_dir)
        before = {name: _versions(state.store(name), day - _dt.timedelta(days=1)) for name in ("constant_values", "customer_reason", "supplier_reason")}
        inputs = (loaded, {n: _versions(self.house.store(n), day) for n in LOADS if LOADS[n].refresh == APPEND},
                  dataclasses.replace(self.p, processing_date=day), before, self.source.source_version(*OTHER_INPUTS))

        def score() -> str:
            t = WarehouseTables(self.spark, self.source.sf_dir, self.house, day)
            daily.run_day(self.spark, t, self.out_dir, day, self.p, day, first_constants)
            return clock.manifest()["days"][day.isoformat()]

        self._stage(day, "score", inputs, score, lambda version: clock.manifest()["days"].get(day.isoformat()) == version)

    def load_day(self, day: _dt.date) -> dict[str, str]:
        """Bring a day's extracts and loads up to date; returns the loaded version of every table."""
        self.ran, self.kept = [], []
        files = {name: self._extract(day, name) for name in LOADS}
        return {name: self._load(day, name, path) for name, path in files.items()}

    def window(self, name: str, day: _dt.date) -> tuple[_dt.date, _dt.date]:
        """First and last day that a day's extract covers."""
        done = [d for d in self.house.store(name).days() if d < day]
        first = self.first_day or dataclasses.replace(self.p, processing_date=day).window_start
        return (done[-1] + _dt.timedelta(days=1) if done and LOADS[name].refresh == APPEND else first), day

    def _extract(self, day: _dt.date, name: str) -> str:
        sources, rows = EXTRACTS[name]
        start, end = self.window(name, day)

        def write() -> str:
            path = f"{self.base}/extracts/{name}/{day.isoformat()}/{uuid.uuid4().hex}"
            publish.export_csv(in_file_order(rows(self.source, start, end), name), path, compression="gzip")
            return path

        window = (start, end) if LOADS[name].refresh == APPEND else None
        return self._stage(day, f"extract {name}", (self.source.source_version(*sources), window), write,
                           lambda path: publish.exists(self.spark, f"{path}/_SUCCESS"))

    def _load(self, day: _dt.date, name: str, path: str) -> str:
        store = self.house.store(name)

        def load() -> str:
            self.house.load(name, path, day)
            return store.manifest()["days"][day.isoformat()]

        return self._stage(day, f"load {name}", path, load, lambda version: store.manifest()["days"].get(day.isoformat()) == version)

    def _stage(self, day: _dt.date, name: str, inputs, build: Callable[[], str], there: Callable[[str], bool]) -> str:
        """The stage's output, computed anew unless the log has it for these inputs."""
        digest = hashlib.sha256(repr(inputs).encode()).hexdigest()
        log = self.recorded(day)
        known = log.get(name)
        if known and known[0] == digest and there(known[1]):
            self.kept.append(name)
            return known[1]
        output = build()
        log[name] = (digest, output)
        # one row for each of the day's stages
        self.log.publish(self.spark.createDataFrame([(n, i, o) for n, (i, o) in sorted(log.items())], LOG_SCHEMA).coalesce(1), day)
        self.ran.append(name)
        return output

    def recorded(self, day: _dt.date) -> dict[str, tuple[str, str]]:
        """Stage -> (digest of inputs, output) of a day."""
        return {r.stage: (r.inputs, r.output) for r in self.log.read(day).collect()} if day in self.log.days() else {}


def _versions(store: Store, upto: _dt.date) -> list[tuple[str, str]]:
    return sorted((d, v) for d, v in store.manifest()["days"].items() if d <= upto.isoformat())
