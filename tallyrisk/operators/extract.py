"""Extraction queries over the raw (OLTP-shaped) source tables.

Each function takes the raw tables it reads and a date window, and returns the
warehouse-shaped relation.  Semantics kept from the source SQL:

* ``LIKE`` in the source database is case-insensitive -> ``ilike``.
* A ``WHERE`` predicate on the null-supplying side turns an outer join into an
  inner one (kept on purpose; Catalyst rewrites it the same way).
* The "first line of a bill" is the line with the smallest id; a correlated
  subquery inside ``ON`` is not supported by Spark, so it is a pre-aggregation
  joined back.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import narrowed
from ..functions.scalar import from_units, units


def in_window(col: str, start: _dt.date | None, end: _dt.date) -> F.Column:
    c = F.col(col)
    cond = c <= F.lit(end)
    return cond if start is None else cond & (c >= F.lit(start))


def next_payment_date(payments: DataFrame) -> DataFrame:
    """Corrected payment date of advance-type payments.

    A payment whose memo looks like an early-payment or factoring advance is
    dated by the next strictly later payment of the same transaction (null when
    there is none); any other payment keeps its own date and is neither shuffled nor sorted.
    The search runs over the distinct days of a transaction (combined before the shuffle), of which there are no more
    than days in the calendar, so a transaction with a third of all payments is a short window; its advances are
    joined by transaction *and* day, which spreads them.
    """
    advance = F.coalesce(F.col("memo").ilike("%Ear%pay%a%") | F.col("memo").ilike("%factor%a%"), F.lit(False))
    asked = payments.filter(advance)
    days = (payments.filter(F.col("txn_id").isNotNull() & F.col("txn_date").isNotNull())
            .groupBy(F.col("txn_id").alias("__txn"), F.col("txn_date").alias("__day")).agg(F.count(F.lit(1)).alias("__n")))
    after = (days.withColumn("corrected_txn_date", F.lead("__day").over(Window.partitionBy("__txn").orderBy("__day"))).drop("__n")
             .filter(F.col("corrected_txn_date").isNotNull()).repartition("__txn", "__day"))
    dated = asked.join(after, (F.col("txn_id") == F.col("__txn")) & (F.col("txn_date") == F.col("__day")), "left").drop("__txn", "__day")
    return dated.unionByName(payments.filter(~advance).withColumn("corrected_txn_date", F.col("txn_date")))


def customer_dimension(customers: DataFrame, ndg: DataFrame) -> DataFrame:
    g = ndg.select(F.col("id").alias("__ndg"), F.col("name").alias("ndg_name"))
    return (customers.join(g, customers["ndg_id"] == g["__ndg"], "left")
            .select("id", "quickbooks_id", F.col("__ndg").alias("ndg_id"), "ndg_name", "name", "customer_type"))


def extract_invoice(invoices: DataFrame, payments: DataFrame, suppliers: DataFrame, customers: DataFrame,
                    ndg: DataFrame, types: DataFrame, start: _dt.date | None, end: _dt.date) -> DataFrame:
    """Invoice x payment rows of the window with supplier, customer, group and type attached."""
    inv = invoices.filter((F.col("client_id") != "") & (F.col("location_job_id") != "") & (F.col("amount") != 0)
                          & in_window("invoice_date", start, end))
    sup = suppliers.select(F.col("id").alias("supplier_id"), F.col("quickbooks_id").alias("__sqb"),
                           F.col("name").alias("client_name"))
    cust = customer_dimension(customers, ndg).select(
        F.col("id").alias("customer_id"), F.col("quickbooks_id").alias("__cqb"), "ndg_id", "ndg_name",
        F.col("name").alias("customer_name"), "customer_type")
    pay = next_payment_date(narrowed(payments, "txn_id", inv, "txn_id")).select(
        F.col("txn_id").alias("__tid"), F.col("amount").alias("txn_amount"),
        F.col("corrected_txn_date").alias("txn_date"), "memo", "txn_type")
    ty = types.select(F.col("id").alias("customer_type_id"), F.col("type").alias("__type"))
    j = (inv.join(sup, inv["client_id"] == sup["__sqb"], "left")
         .join(cust, inv["location_job_id"] == cust["__cqb"], "left")
         .join(pay, inv["txn_id"] == pay["__tid"], "left")
         .join(ty, F.col("customer_type") == F.col("__type"), "left")
         .filter(F.col("__cqb").isNotNull() & F.col("__sqb").isNotNull()))
    return j.select("supplier_id", "client_name", "invoice_date", "invoice_num", "po_number",
                    F.col("__cqb").alias("quickbooks_id"), "ndg_id", "ndg_name", "customer_id", "customer_name",
                    "customer_type_id", "customer_type", "ispaid", "balance", F.col("amount").alias("invoice_amount"),
                    "txn_amount", "txn_date", "memo", "txn_type", "duedate", "ship_location")


def first_lines(lines: DataFrame) -> DataFrame:
    """The first (smallest id) line of every bill."""
    first = F.rank().over(Window.partitionBy("bm_transaction_id").orderBy("id"))     # each task leaves all but its own first lines out
    known = lines.filter(F.col("bm_transaction_id").isNotNull() & F.col("id").isNotNull())
    return known.withColumn("__place", first).filter("__place = 1").drop("__place")


def _payment_totals(payments: DataFrame) -> DataFrame:
    """Per bill: number of payments, their exact sum and the latest payment date (numeric hash aggregate)."""
    return payments.groupBy(F.col("bm_transaction_id").alias("__pbill")).agg(
        F.count(F.lit(1)).alias("__n_pay"), F.sum(units("bm_accounting_payment_amount")).alias("__paid_u"),
        F.max("bm_accounting_payment_date").alias("paid_date"))


def _with_payments(base: DataFrame, fan_out: F.Column) -> DataFrame:
    """Bill-level totals as the source computes them over the bill's first line joined with its payments and its other
    joined rows: the line amount counts once per payment row (once when there is none) and every amount once for each of
    the ``fan_out`` rows."""
    n = F.greatest(F.coalesce(F.col("__n_pay"), F.lit(0)), F.lit(1))
    top = F.coalesce(F.substring_index(F.col("account_full_name"), ":", 1), F.lit(""))
    return base.select("*", top.alias("summary_acct"),
                       from_units(units("line_amount") * n * fan_out).alias("total_amount"),
                       from_units(F.coalesce(F.col("__paid_u"), F.lit(0)) * fan_out).alias("paid_amount"))


def _bill_lines_view(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    fl = first_lines(lines).select(F.col("bm_transaction_id").alias("__bill"), "client_class_id",
                                   "expense_account_id", F.col("amount").alias("line_amount"))
    return fl.join(accounts, fl["expense_account_id"] == accounts["account_id"], "left")


def vendor_companies(links: DataFrame, companies: DataFrame) -> DataFrame:
    """Per vendor: how many companies it is linked to, and the first one's name."""
    c = companies.select(F.col("id").alias("company_id"), "company_name")
    return (links.join(c, "company_id", "left").groupBy("vendor_id")
            .agg(F.count(F.lit(1)).alias("__n_party"), F.min_by("company_name", "company_id").alias("vendor")))


def vendor_customers(links: DataFrame, companies: DataFrame, company_customers: DataFrame, customers: DataFrame,
                     ndg: DataFrame, types: DataFrame) -> DataFrame:
    """Per vendor: the rows of vendor -> company -> customer, and the one of smallest customer and company id.

    The source joins this fan-out to every bill and then takes any of its rows; here it is summed per vendor once, and
    the row taken is the first.
    """
    who = customer_dimension(customers, ndg).select(F.col("id").alias("customer_id"), "ndg_id", "ndg_name",
                                                    F.col("name").alias("customer_name"), "customer_type")
    kind = types.select(F.col("id").alias("customer_type_id"), F.col("type").alias("customer_type"))
    rows = (links.join(companies.select(F.col("id").alias("company_id"), "company_name"), "company_id")
            .join(company_customers, "company_id").join(who, "customer_id").join(kind, "customer_type", "left"))
    first = F.min_by(F.struct("company_name", "customer_id", "customer_name", "customer_type", "customer_type_id", "ndg_id", "ndg_name"),
                     F.struct("customer_id", "company_id"))
    return rows.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("__n_party"), first.alias("party"))


def extract_chargebacks(bills: DataFrame, lines: DataFrame, accounts: DataFrame, payments: DataFrame, parties: DataFrame,
                        suppliers: DataFrame, entities: DataFrame, metadata: DataFrame, start: _dt.date | None,
                        end: _dt.date) -> DataFrame:
    """Chargeback bills of the window: one row per bill whose first line books to 'Chargebacks' and whose vendor
    (``parties``, see ``vendor_customers``) leads to a customer.

    Totals follow the source's joins: an amount counts once for each joined row (payments, vendor's customers,
    accounting metadata).  Each of these is pre-aggregated, so a bill is one row throughout.  The source's joins with brands
    and markets, by unique id and without output, have no effect and are left out.
    """
    b = bills.filter((F.col("archived") == 0) & in_window("transaction_date", start, end))
    lines, payments = (narrowed(x, "bm_transaction_id", b, "id") for x in (lines, payments))
    fl = _bill_lines_view(lines, accounts)
    sup = suppliers.select(F.col("id").alias("supplier_id"), F.col("name").alias("client_name"))
    unit = entities.select(F.col("id").alias("__entity"), F.col("name").alias("entity"))
    meta = metadata.groupBy(F.col("txn_id").alias("accounting_transaction_id")).agg(F.count(F.lit(1)).alias("__n_meta"))
    base = (b.join(fl, b["id"] == fl["__bill"], "inner")
            .join(parties, "vendor_id", "inner")
            .join(sup, fl["client_class_id"] == sup["supplier_id"], "left")
            .join(unit, F.col("subsidiary_id") == F.col("__entity"), "left")
            .join(meta, "accounting_transaction_id", "left")
            .join(_payment_totals(payments), b["id"] == F.col("__pbill"), "left"))
    g = _with_payments(base, F.col("__n_party") * F.coalesce(F.col("__n_meta"), F.lit(1)))
    return g.filter(F.col("summary_acct") == "Chargebacks").select(
        F.col("transaction_number").alias("reference_num"), "supplier_id", "client_name", "entity",
        F.col("transaction_type").alias("type"), "summary_acct",
        F.when(F.col("is_paid") == 1, "Paid").otherwise("Open").alias("bill_status"), "party.ndg_id", "party.ndg_name",
        "party.customer_id", "party.customer_type_id", "party.customer_type",
        F.col("party.company_name").alias("vendor"), "party.customer_name", "total_amount",
        F.col("balance").alias("open_balance"), "paid_amount", F.col("transaction_date").alias("bill_date"),
        F.col("due_date").alias("cb_duedate"), "paid_date")


def bill_account_summary(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per bill: the distinct top-level accounts of all its lines (sorted, comma-joined);
    only bills booked to chargebacks alone are kept."""
    j = lines.join(accounts, lines["expense_account_id"] == accounts["account_id"], "left")
    top = F.substring_index(F.col("account_full_name"), ":", 1)
    g = j.groupBy("bm_transaction_id").agg(F.array_join(F.array_sort(F.collect_set(top)), ",").alias("summary_acct"),
                                           F.count(F.lit(1)).alias("n_lines"))
    return g.filter(F.col("summary_acct") == "Chargebacks")


def supplier_status(snapshots: DataFrame, options: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Supplier contract status: snapshots with their type-1 status option, per supplier.

    The source writes it as a right join filtered on the option type, which
    keeps only suppliers with a snapshot whose state has a type-1 option.
    """
    j = (snapshots.join(options, snapshots["contract_states"] == options["status_index"], "left")
         .join(suppliers, snapshots["client_id"] == suppliers["quickbooks_id"], "right")
         .filter(F.col("type") == 1))
    return j.select("id", "quickbooks_id", "client_id", "name", "status_index", "display_name", "status_short",
                    "status", "cash_balance")


def extract_other_open_payables(bills, lines, accounts, payments, companies, suppliers, status,
                                start: _dt.date | None, end: _dt.date) -> DataFrame:
    """Open non-chargeback payables per bill, with the supplier's contract status (``companies``: see ``vendor_companies``)."""
    b = bills.filter((F.col("archived") == 0) & in_window("transaction_date", start, end))
    lines, payments = (narrowed(x, "bm_transaction_id", b, "id") for x in (lines, payments))
    fl = _bill_lines_view(lines, accounts)
    sup = suppliers.select(F.col("id").alias("client_id"), F.col("name").alias("supplier"))
    pay = _payment_totals(payments)
    base = (b.join(fl, b["id"] == fl["__bill"], "left")
            .join(companies, "vendor_id", "left")
            .join(sup, fl["client_class_id"] == sup["client_id"], "left")
            .join(pay, b["id"] == pay["__pbill"], "left"))
    g = _with_payments(base, F.coalesce(F.col("__n_party"), F.lit(1)))
    paid, bal, tot = F.col("paid_amount"), F.col("balance"), F.col("total_amount")
    out = g.select(
        F.col("transaction_number").alias("reference_num"),
        F.when(F.col("transaction_type") == "credit",
               F.replace(F.col("transaction_number"), F.lit("CR"), F.lit("A"))).otherwise(F.lit("0"))
        .alias("replace_ref_num"),
        F.when(paid == 0, F.when(bal > tot, bal).otherwise(tot)).otherwise(paid + bal).alias("new_total"),
        "client_id", "supplier", F.col("transaction_type").alias("type"), "summary_acct",
        F.when(F.col("is_paid") == 1, "Paid").otherwise("Open").alias("bill_status"),
        "vendor", "total_amount", F.col("balance").alias("other_open_payables"),
        "paid_amount", F.col("transaction_date").alias("bill_date"), F.col("due_date").alias("cb_duedate"),
        "paid_date")
    st = status.select(F.col("id").alias("__sid"), F.col("client_id").alias("cl_id"), "name", "status_index",
                       "display_name", "status_short", "status")
    return (out.join(st, out["client_id"] == st["__sid"], "left")
            .filter((F.col("bill_status") == "Open") & F.col("client_id").isNotNull())
            .withColumnRenamed("__sid", "id"))


def extract_open_payable(supplier_invoice: DataFrame, status: DataFrame, start, end) -> DataFrame:
    """Unpaid supplier invoices per purchase order (mean balance, latest dates) with status."""
    po = (supplier_invoice.filter(F.col("invoice_status") == 1).groupBy("po_num")
          .agg(F.min("client_id").alias("id"), F.avg("balance").alias("open_payable"),
               F.max("txn_date").alias("invoice_date"), F.max("due_date").alias("due_date")))
    st = status.select(F.col("id").alias("__sid"), "client_id", "name", "status_index", "status", "status_short",
                       "display_name")
    j = po.join(st, po["id"] == st["__sid"], "left").filter(in_window("invoice_date", start, end))
    return j.select("id", "client_id", "name", "status_index", "status", "open_payable", "invoice_date", "due_date",
                    "status_short", "display_name")


def extract_unapplied_balance(supplier_invoice: DataFrame, status: DataFrame, start, end) -> DataFrame:
    """Unapplied balance per purchase order: ``avg(total) * 100 / 75 - avg(total)``, with status."""
    po = (supplier_invoice.groupBy("po_num")
          .agg(F.min("client_id").alias("id"), F.avg("total_amount").alias("__avg"),
               F.max("txn_date").alias("invoice_date")))
    po = po.withColumn("unapplied_amount", F.col("__avg") * 100 / 75 - F.col("__avg"))
    st = status.select(F.col("id").alias("__sid"), "client_id", F.col("name").alias("supplier"), "status_index",
                       "status", "status_short", "display_name")
    j = po.join(st, po["id"] == st["__sid"], "left").filter(in_window("invoice_date", start, end))
    return j.select("id", "client_id", "supplier", "status_index", "status", "unapplied_amount", "invoice_date",
                    "status_short", "display_name")


def extract_credit_memo(memos: DataFrame, status: DataFrame, start, end) -> DataFrame:
    """Open credit memos of the window with the supplier's status (matched on the supplier reference)."""
    m = memos.filter((F.col("status_id") == 1) & in_window("creditmemo_date", start, end))
    st = status.select(F.col("quickbooks_id").alias("__qb"), F.col("name").alias("supplier"), "status_index",
                       "status", "status_short", "display_name")
    j = m.join(st, m["client_id"] == st["__qb"], "left")
    return j.select("creditmemo_date", "client_id", "supplier", "status_index", "status", "amount", "status_short",
                    "display_name")


def extract_cash_balance(snapshots, options, suppliers) -> DataFrame:
    """Cash balance snapshots with a type-1 status (the filter makes the right join an inner one)."""
    s = supplier_status(snapshots, options, suppliers)
    return s.select("id", "client_id", F.col("name").alias("supplier"), "status_index", "status", "display_name",
                    "status_short", "cash_balance")


def extract_contract_status(snapshots, options, suppliers) -> DataFrame:
    """Every supplier with its status; the option type is part of the join condition, so suppliers
    without a type-1 status are kept with nulls."""
    so = snapshots.join(options, snapshots["contract_states"] == options["status_index"], "left")
    j = so.join(suppliers, (so["client_id"] == suppliers["quickbooks_id"]) & (so["type"] == 1), "right")
    return j.select("id", "client_id", "name", "status_short", "display_name", "status_index", "status")


def extract_suppliers(suppliers, snapshots, options) -> DataFrame:
    """Supplier dimension with its type-1 contract status (left joins)."""
    j = (suppliers.join(snapshots, snapshots["client_id"] == suppliers["quickbooks_id"], "left")
         .join(options, (options["status_index"] == snapshots["contract_states"]) & (options["type"] == 1), "left"))
    return j.select(F.col("id").alias("supplier_id"), F.col("name").alias("supplier"), "status_index", "status",
                    "display_name", "status_short")


def extract_customers(customers, types, ndg) -> DataFrame:
    """Customer dimension with type id and group name."""
    ty = types.select(F.col("id").alias("customer_type_id"), F.col("type").alias("__type"))
    g = ndg.select(F.col("id").alias("__ndg"), F.col("name").alias("ndg_name"))
    j = (customers.join(ty, customers["customer_type"] == ty["__type"], "left")
         .join(g, customers["ndg_id"] == g["__ndg"], "left"))
    return j.select("ndg_name", "ndg_id", F.col("id").alias("customer_id"), F.col("name").alias("customer"),
                    "customer_type", "customer_type_id")


def extract_ndg(ndg) -> DataFrame:
    """Customer groups: id, name, type."""
    return ndg.select("id", "name", "type")
