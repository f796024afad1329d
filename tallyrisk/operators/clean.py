"""Window scans, invoice cleaning and the unified ledger (invoices + chargebacks)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, Params


def scan_window(df: DataFrame, date_col: str, p: Params = DEFAULT) -> DataFrame:
    """Rows whose ``date_col`` lies in the trailing window ``[D - 729, D]``.

    A plain range predicate on a column: pushed into the parquet scan (and a
    partition filter when the table is partitioned by that date).
    """
    return df.filter(F.col(date_col).between(F.lit(p.window_start), F.lit(p.processing_date)))


def clean_early_advance(inv: DataFrame) -> DataFrame:
    """Zero the payment of early-payment advances that have no transaction yet.

    A row whose memo mentions "Early payment advancement" (any case) and whose
    invoice number occurs exactly once gets ``txn_amount = 0``.  Rows without an
    invoice number are never touched.  Only the numbers of advance rows are counted (a semi join and a grouped
    count of that one column), and only advance rows are joined; all other rows pass by without a shuffle.
    """
    advance = F.col("invoice_num").isNotNull() & F.coalesce(F.col("memo").rlike("(?i)early payment advancement"), F.lit(False))
    asked = inv.filter(advance)
    once = (inv.select("invoice_num").join(asked.select("invoice_num").distinct(), "invoice_num", "left_semi")
            .groupBy(F.col("invoice_num").alias("__num")).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").select("__num"))
    mended = asked.join(once, asked["invoice_num"] == once["__num"], "left").withColumn(
        "txn_amount", F.when(F.col("__num").isNotNull(), F.lit(0.0)).otherwise(F.col("txn_amount"))).drop("__num")
    return inv.filter(~advance).unionByName(mended)


def drop_full_credit_memo(inv: DataFrame) -> DataFrame:
    """Drop credit memos that cancel their whole invoice (null comparison keeps the row)."""
    full = (F.col("txn_type") == "CreditMemo") & (F.abs(F.col("txn_amount")) == F.col("invoice_amount"))
    return inv.filter(~F.coalesce(full, F.lit(False)))


LEDGER_COLUMNS = (
    "src", "customer_id", "supplier_id", "invoice_num", "ispaid", "invoice_date", "duedate", "txn_date",
    "invoice_amount", "txn_amount", "balance", "total_amount", "open_balance", "paid_amount",
    "bill_date", "cb_duedate", "paid_date", "ndg_id", "ndg_name", "customer_name", "client_name",
    "customer_type_id", "customer_type",
)


def clean_invoices(invoice_payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Window scan, early-advance fix, credit-memo removal."""
    inv = scan_window(invoice_payments, "invoice_date", p)
    return drop_full_credit_memo(clean_early_advance(inv))


def fill_ledger(df: DataFrame) -> DataFrame:
    """Missing amounts -> 0, missing due date -> invoice date + 30, missing ispaid -> 2, group sentinels."""
    df = df.fillna(0.0, subset=["balance", "invoice_amount", "open_balance", "paid_amount", "total_amount",
                                "txn_amount"])
    return df.select(
        *[c for c in df.columns if c not in ("duedate", "ispaid", "ndg_name", "ndg_id")],
        F.coalesce(F.col("duedate"), F.date_add(F.col("invoice_date"), 30)).alias("duedate"),
        F.coalesce(F.col("ispaid"), F.lit(2)).cast("int").alias("ispaid"),
        F.coalesce(F.col("ndg_name"), F.lit("None")).alias("ndg_name"),
        F.coalesce(F.col("ndg_id"), F.lit(-1)).cast("long").alias("ndg_id"),
    )


def unified_ledger(invoice_payments: DataFrame, chargebacks: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Cleaned invoices stacked with the window's chargebacks (``ispaid = 2``), gaps filled.

    Rows without a customer or supplier are left out: they cannot belong to a pair.
    """
    inv = clean_invoices(invoice_payments, p).withColumn("src", F.lit("inv"))
    cb = (scan_window(chargebacks, "bill_date", p)
          .withColumn("src", F.lit("cb")).withColumn("ispaid", F.lit(2)))
    stacked = inv.unionByName(cb, allowMissingColumns=True)
    stacked = stacked.select(*[c for c in LEDGER_COLUMNS if c in stacked.columns])
    return (fill_ledger(stacked)
            .filter(F.col("customer_id").isNotNull() & F.col("supplier_id").isNotNull()))


def customer_attributes(ledger: DataFrame) -> DataFrame:
    """One row of descriptive attributes per customer.

    The group is the highest real group id (the ``-1`` sentinel only when no row
    has one); names and types are functionally dependent on the customer id, the
    maximum is taken so the choice is deterministic.  The distinct projection
    first keeps string maxima (sort-based aggregation) off the full ledger.
    """
    src = ledger.select("customer_id", "ndg_id", "ndg_name", "customer_name", "customer_type_id",
                        "customer_type").distinct()
    return src.groupBy("customer_id").agg(
        F.max("ndg_id").alias("ndg_id"),
        F.max_by("ndg_name", "ndg_id").alias("ndg_name"),
        F.max("customer_name").alias("customer_name"),
        F.max("customer_type_id").alias("customer_type_id"),
        F.max("customer_type").alias("customer_type"),
    )


def historical_pairs(ledger: DataFrame) -> DataFrame:
    """Distinct (customer, supplier) pairs seen in the window, as text (history table format)."""
    src = ledger.select("customer_id", "supplier_id", "customer_name", "client_name").distinct()
    return (src.groupBy("customer_id", "supplier_id")
            .agg(F.max("customer_name").alias("customer"), F.max("client_name").alias("supplier"))
            .select(F.col("customer_id").cast("string").alias("customer_id"), "customer",
                    F.col("supplier_id").cast("string").alias("supplier_id"), "supplier"))
