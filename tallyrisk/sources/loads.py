"""Typed loads: the eleven positional CSV files of a day, their schemas, tables and rejected rows.

Each file has a header and a leading row number; its other columns are taken by position.  Everything is read as text and cast leniently: a row
is *rejected* if its number of columns differs, if a value cannot be read as its column's type (a null or empty value can), or if
a key is missing.  Rejected rows land in a table of their own with the file, the row number, the text and all reasons; nothing becomes null
silently, and rows read = rows loaded + rows rejected.

Full loads replace the table, append loads add their day; both are published by one commit (``Store``), and loading a day again replaces that day only.
One scan writes the good rows and counts both kinds; the file is scanned again for the rejected rows only if there are any.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .publish import INDEX_COL
from .store import Store
from .tables import Tables

FULL, APPEND = "full", "append"
CORRUPT = "_corrupt"


TYPES = {"BIGINT": T.LongType, "INT": T.IntegerType, "DOUBLE": T.DoubleType, "DATE": T.DateType, "STRING": T.StringType}


@dataclass(frozen=True)
class Load:
    """One file: how it is refreshed, its key columns and its columns in file order."""

    refresh: str
    keys: tuple[str, ...]
    ddl: str

    @property
    def schema(self) -> T.StructType:
        pairs = (c.split() for c in self.ddl.split(","))
        return T.StructType([T.StructField(name, TYPES[kind]()) for name, kind in pairs])


_STATUS = "status_index INT, status STRING"
#: fixed values: names, order and types of the loaded columns
LOADS: dict[str, Load] = {
    "invoice_payments": Load(APPEND, (), """supplier_id BIGINT, client_name STRING, invoice_date DATE, invoice_num BIGINT, po_number STRING,
        quickbooks_id STRING, ndg_id BIGINT, ndg_name STRING, customer_id BIGINT, customer_name STRING, customer_type_id INT,
        customer_type STRING, ispaid INT, balance DOUBLE, invoice_amount DOUBLE, txn_amount DOUBLE, txn_date DATE, memo STRING,
        txn_type STRING, duedate DATE, ship_location STRING"""),
    "chargebacks": Load(APPEND, (), """reference_num STRING, supplier_id BIGINT, client_name STRING, entity STRING, type STRING,
        summary_acct STRING, bill_status STRING, ndg_id BIGINT, ndg_name STRING, customer_id BIGINT, customer_type_id INT,
        customer_type STRING, vendor STRING, customer_name STRING, total_amount DOUBLE, open_balance DOUBLE, paid_amount DOUBLE,
        bill_date DATE, cb_duedate DATE, paid_date DATE"""),
    "open_payable": Load(APPEND, (), f"""id BIGINT, client_id STRING, name STRING, {_STATUS}, open_payable DOUBLE, invoice_date DATE,
        due_date DATE, status_short STRING, display_name STRING"""),
    "other_open_payables": Load(APPEND, (), """reference_num STRING, replace_ref_num STRING, new_total DOUBLE, client_id BIGINT,
        supplier STRING, type STRING, summary_acct STRING, bill_status STRING, vendor STRING, total_amount DOUBLE,
        other_open_payables DOUBLE, paid_amount DOUBLE, bill_date DATE, cb_duedate DATE, paid_date DATE, id BIGINT, cl_id STRING,
        name STRING, status_index INT, display_name STRING, status_short STRING, status STRING"""),
    "credit_memo": Load(APPEND, (), f"""creditmemo_date DATE, client_id STRING, supplier STRING, {_STATUS}, amount DOUBLE,
        status_short STRING, display_name STRING"""),
    "unapplied_balance": Load(APPEND, (), f"""id BIGINT, client_id STRING, supplier STRING, {_STATUS}, unapplied_amount DOUBLE,
        invoice_date DATE, status_short STRING, display_name STRING"""),
    "cash_balance": Load(FULL, (), f"""id BIGINT, client_id STRING, supplier STRING, {_STATUS}, display_name STRING, status_short STRING,
        cash_balance DOUBLE"""),
    "contract_status": Load(FULL, (), f"""id BIGINT, client_id STRING, name STRING, status_short STRING, display_name STRING, {_STATUS}"""),
    "crm_classes": Load(FULL, ("supplier_id",), f"""supplier_id BIGINT, supplier STRING, {_STATUS}, display_name STRING, status_short STRING"""),
    "crm_customers": Load(FULL, ("customer_id",), """ndg_name STRING, ndg_id BIGINT, customer_id BIGINT, customer STRING, customer_type STRING,
        customer_type_id INT"""),
    "crm_ndg": Load(FULL, ("id",), """id BIGINT, name STRING, works_with_bdn STRING, credentials STRING, online_access_sop STRING,
        bdn_authorization_letter_sop STRING, online_access_possible STRING, distributor_data STRING, online_system_url STRING,
        online_system_notes STRING, type STRING"""),
}


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """The columns of a load in file order; columns that ``df`` lacks are null."""
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast("string").alias(f.name) for f in LOADS[name].schema])


def read_text(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A file's columns as text, with the row number, the whole row where its number of columns differs, and the file."""
    cols = [T.StructField(c, T.StringType()) for c in (INDEX_COL, *LOADS[name].schema.names, CORRUPT)]
    # every column is parsed in every scan, else a row with too few would pass where not all are read
    return (spark.read.schema(T.StructType(cols)).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def checked(text: DataFrame, name: str) -> DataFrame:
    """The typed columns, with ``_reasons``: why the row is rejected (empty: it is not)."""
    load = LOADS[name]
    typed, reasons = [], [F.when(F.col(CORRUPT).isNotNull(), F.lit("number of columns"))]
    for f in load.schema:
        if isinstance(f.dataType, T.StringType):
            typed.append(F.col(f.name))
            continue
        cast = F.col(f.name).try_cast(f.dataType)
        typed.append(cast.alias(f.name))
        unread = F.col(CORRUPT).isNull() & F.col(f.name).isNotNull() & cast.isNull()
        reasons.append(F.when(unread, F.concat(F.lit(f"{f.name}: "), F.col(f.name))))
    for k in load.keys:
        reasons.append(F.when(F.col(CORRUPT).isNull() & F.col(k).isNull(), F.lit(f"{k}: missing")))
    row = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(INDEX_COL, *load.schema.names)))
    return text.select(*typed, F.array_compact(F.array(*reasons)).alias("_reasons"), F.col(INDEX_COL).alias("_row"),
                       row.alias("_text"), "_file")


@dataclass(frozen=True)
class Loaded:
    name: str
    rows: int
    loaded: int
    rejected: int


class Warehouse:
    """The loaded tables of one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def store(self, name: str) -> Store:
        return Store(self.spark, f"{self.base}/tables/{name}", "load_date")

    def reject_store(self, name: str) -> Store:
        return Store(self.spark, f"{self.base}/rejects/{name}", "load_date")

    def load(self, name: str, path: str, day: _dt.date) -> Loaded:
        """Load a day's file; the rejected rows are committed first, so a published day always has its rejects."""
        rows = checked(read_text(self.spark, name, path), name)
        bad = F.size("_reasons") > 0
        seen = Observation()
        good = (rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"))
                .filter(~bad).select(*LOADS[name].schema.names))
        version = self.store(name).stage(good, day)
        n, rejected = seen.get["rows"], seen.get["rejected"]
        found = rows.filter(bad) if rejected else rows.filter(F.lit(False))
        self.reject_store(name).publish(found.select(F.lit(name).alias("load"), F.col("_file").alias("file"), F.col("_row").alias("row"),
                                                     F.col("_reasons").alias("reasons"), F.col("_text").alias("text")), day)
        self.store(name).commit(day, version)
        self.store(name).prune()
        return Loaded(name, n, n - rejected, rejected)

    def load_all(self, folder: str, day: _dt.date) -> list[Loaded]:
        return [self.load(name, f"{folder.rstrip('/')}/{name}", day) for name in LOADS]

    def table(self, name: str, day: _dt.date | None = None) -> DataFrame:
        """Full loads: the last day's rows; append loads: all days' rows.  With ``day``: as they were loaded up to it."""
        store = self.store(name)
        if LOADS[name].refresh == FULL:
            found = store.current() if day is None else store.as_of(day)
            if found is None:
                raise FileNotFoundError(f"{name} is not loaded up to {day}")
        else:
            found = store.history() if day is None else store.history().filter(F.col("load_date") <= F.lit(day))
        return found.drop("load_date")

    def rejects(self, name: str) -> DataFrame:
        return self.reject_store(name).history()


class WarehouseTables(Tables):
    """The relations of a scoring run: the loaded tables from the warehouse, everything else from ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, warehouse: Warehouse, day: _dt.date | None = None):
        super().__init__(spark, sf_dir)
        self.warehouse, self.day = warehouse, day

    def __getitem__(self, name: str) -> DataFrame:
        if name in LOADS and name not in self._cache:
            self._cache[name] = self.warehouse.table(name, self.day)
        return super().__getitem__(name)

    def within(self, name: str, start: _dt.date, end: _dt.date) -> DataFrame:
        return self[name] if name in LOADS else super().within(name, start, end)


# ------------------------------------------------------------------ facts by date

def write_by_date(df: DataFrame, path: str, date_col: str, spread: list[str], files: int = 4) -> None:
    """A fact table partitioned by date, at most ``files`` files for each date: a date's rows go to that many tasks by a hash of
    ``spread``, so a date with very many rows (or none, null) is not one task's."""
    (df.repartition(F.col(date_col), F.pmod(F.xxhash64(*spread), F.lit(files)))
     .write.mode("overwrite").partitionBy(date_col).parquet(path))


def read_by_date(spark: SparkSession, path: str, like: T.StructType) -> DataFrame:
    """With the columns and types of ``like``; filters on the date become partition filters."""
    return spark.read.schema(like).parquet(path)
