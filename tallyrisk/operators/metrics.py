"""Behavioural metrics of every (customer, supplier) pair.

Plan: the ledger's rows are dealt by customer once; per invoice, per pair and per
customer they are aggregated where they are, so the metric table needs neither a
join nor another shuffle.  The rows of customers with a huge share of the ledger
are not dealt: they are combined by each map task before they are shuffled.  All money is
summed as exact integer units (see ``functions.scalar``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import from_units, units
from ..params import DEFAULT, Params
from .clean import customer_attributes
from .normalize import dealt

PAIR = ["customer_id", "supplier_id"]

COUNT_METRICS = ("invoice_freq", "suppliers_freq", "chargeback_freq", "open_chargeback_freq",
                 "num_supplier_w_open_invoice", "supplier_wo_overdue_cb", "supplier_w_overdue_cb")

METRIC_COLUMNS = (
    "invoice_freq", "total_invoice", "paid_invoice", "unpaid_invoice", "early_payment_perc",
    "early_payment_amount", "early_payment_days", "open_ar", "aging_balance", "outstanding_balance",
    "payment_timeliness_ratio", "late_payment_ratio_lt10", "late_payment_ratio_gt10", "dbt", "payment_cycle",
    "delinquent_payment_lt10", "delinquent_overdueday_lt10", "delinquent_payment_gt10",
    "delinquent_overdueday_gt10", "payment_predictor", "suppliers_freq", "chargeback_freq",
    "chargeback_vol_amt", "chargeback_vol_paid", "chargeback_vol_unpaid", "supplier_wo_overdue_cb",
    "supplier_w_overdue_cb", "overdue_chargebacks", "early_chargeback", "timeliness_of_chargeback",
    "risk_balance", "w_o_open_cb", "total_ar", "payment1_percent", "payment2_percent",
    "open_chargeback_freq", "open_chargeback_vol_amt", "num_supplier_w_open_invoice", "payment2_percent_wo_cb",
)
ATTRIBUTE_COLUMNS = ("ndg_id", "ndg_name", "customer_id", "supplier_id", "customer_name", "supplier_name",
                     "customer_type_id", "customer_type")


def _cnt(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _usum(amount: str, cond: Column) -> Column:
    return F.sum(F.when(cond, units(amount)))


def _days_sum(days: Column, amount: Column, cond: Column) -> Column:
    """Exact sum of days x units where cond holds: a hot pair's total does not fit a long."""
    return F.sum(F.when(cond, days.cast("decimal(10,0)") * amount.cast("decimal(20,0)")))


def _uavg(amount: str, cond: Column) -> Column:
    """Mean amount of the rows where cond holds, in whole units."""
    return F.round(F.avg(F.when(cond, units(amount)))).cast("long")


def _invoice_columns(p: Params) -> list[Column]:
    """Additive partials of an invoice's rows."""
    D = F.lit(p.processing_date)
    c = F.col
    counted = c("ispaid").isin(0, 1)
    P, U = c("ispaid") == 1, c("ispaid") == 0
    txn_le_D = c("txn_date") <= D
    E1 = P & (c("txn_date") <= c("duedate"))
    L1 = P & (c("txn_date") > c("duedate"))
    E = E1 | (U & (c("txn_date") <= c("duedate")) & txn_le_D)
    L = L1 | (U & (c("txn_date") > c("duedate")) & txn_le_D)
    late = F.datediff(c("txn_date"), c("duedate"))
    paid_with_date = P & c("txn_date").isNotNull()
    return [
        _cnt(counted).alias("i_rows"),
        _cnt(P).alias("i_p_rows"),
        _cnt(U).alias("i_u_rows"),
        _cnt(U & (c("duedate") >= D)).alias("i_u_ge_rows"),
        _uavg("invoice_amount", P).alias("i_amt_p"),
        _uavg("invoice_amount", U).alias("i_amt_u"),
        _uavg("invoice_amount", U & (c("duedate") < D)).alias("i_amt_u_lt"),
        _uavg("invoice_amount", U & (c("duedate") >= D)).alias("i_amt_u_ge"),
        F.min(F.when(U, c("duedate"))).alias("i_u_due"),
        _usum("txn_amount", U & txn_le_D).alias("i_t_u"),
        _usum("txn_amount", U & (c("duedate") < D) & txn_le_D).alias("i_t_u_lt"),
        _usum("txn_amount", U & (c("duedate") >= D) & txn_le_D).alias("i_t_u_ge"),
        _usum("txn_amount", E).alias("i_e_sum"),
        _cnt(E1).alias("i_e1_rows"),
        F.sum(F.when(E1, F.datediff(c("duedate"), c("txn_date")))).alias("i_e1_days"),
        _days_sum(F.datediff(c("txn_date"), c("invoice_date")), units("txn_amount"), paid_with_date).alias("i_pc_num"),
        _days_sum(late, units("txn_amount"), paid_with_date).alias("i_dbt_num"),
        _usum("txn_amount", paid_with_date).alias("i_pc_den"),
        _cnt(paid_with_date).alias("i_pc_rows"),
        _cnt(L1 & (late <= 10)).alias("i_l1_le10_rows"),
        _cnt(L1 & (late > 10)).alias("i_l1_gt10_rows"),
        _usum("txn_amount", L & (late <= 10)).alias("i_l_le10_sum"),
        _cnt(L & (late <= 10)).alias("i_l_le10_rows"),
        F.sum(F.when(L & (late <= 10), late)).alias("i_l_le10_days"),
        _usum("txn_amount", L & (late > 10)).alias("i_l_gt10_sum"),
        _cnt(L & (late > 10)).alias("i_l_gt10_rows"),
        F.sum(F.when(L & (late > 10), late)).alias("i_l_gt10_days"),
        F.max(F.when(counted, F.datediff(c("duedate"), c("invoice_date")))).alias("i_terms_max"),
    ]


def _chargeback_columns(p: Params) -> list[Column]:
    """Additive partials of chargeback rows."""
    D = F.lit(p.processing_date)
    c = F.col
    cb = c("src") == "cb"
    is_open = c("open_balance") != 0
    closed = c("open_balance") == 0
    early = closed & (c("paid_date") <= c("cb_duedate"))

    def added(value: Column, cond: Column | None = None) -> Column:
        return F.sum(F.when(cb if cond is None else cb & cond, value))

    one = F.lit(1)
    return [
        added(one).alias("cb_rows"),
        added(F.abs(units("total_amount"))).alias("cb_total_abs"),
        added(F.abs(units("open_balance"))).alias("cb_open_abs"),
        added(F.abs(units("total_amount")) - units("open_balance")).alias("cb_paid_part"),
        added(F.abs(units("paid_amount")), is_open & (c("cb_duedate") < D)).alias("cb_overdue"),
        added(F.abs(units("paid_amount")), early).alias("cb_early"),
        added(one, early).alias("cb_early_rows"),
        added(one, is_open).alias("cb_open_rows"),
        added(F.abs(units("total_amount")), is_open).alias("cb_open_total"),
        added(one, closed).alias("cb_closed_rows"),
        F.max(F.when(cb & (c("paid_date") <= c("cb_duedate")), one)).alias("cb_on_time"),
        F.max(F.when(cb & (c("paid_date") > c("cb_duedate")), one)).alias("cb_late"),
    ]


#: descriptive columns of a pair, one value a pair (``described_pairs``)
DESCRIPTION = ("supplier_name", "ndg_id", "ndg_name", "customer_name", "customer_type_id", "customer_type")


def partials(ledger: DataFrame, p: Params = DEFAULT, described: Sequence[str] = ()) -> DataFrame:
    """First level: one row per (customer, supplier, invoice_num) with additive partials of its invoice and chargeback rows.

    Chargebacks have no invoice number: a pair's are one row, with its invoice rows without number if there are any.
    """
    rows = ledger.filter(F.col("ispaid").isin(0, 1) | (F.col("src") == "cb"))
    return rows.groupBy(*PAIR, *described, "invoice_num").agg(*_invoice_columns(p), *_chargeback_columns(p))


def overdue_cb_suppliers(pair_agg: DataFrame) -> DataFrame:
    """Global distinct counts of suppliers with chargebacks paid on time / late (one row), from the pair aggregate."""
    return pair_agg.agg(
        F.countDistinct(F.when(F.col("any_on_time") == 1, F.col("supplier_id"))).alias("supplier_wo_overdue_cb"),
        F.countDistinct(F.when(F.col("any_late") == 1, F.col("supplier_id"))).alias("supplier_w_overdue_cb"))


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double")) * 100


def pair_aggregate(ledger: DataFrame, p: Params = DEFAULT, described: Sequence[str] = ()) -> DataFrame:
    """Sums, counts and flags of each pair, from which its metrics are derived; with columns (``described``) that have one value a pair."""
    c = F.col
    parts = partials(ledger, p, described)
    has_inv = c("invoice_num").isNotNull() & (c("i_rows") > 0)

    def s(col: str, cond: Column | None = None) -> Column:
        return F.coalesce(F.sum(F.when(cond, c(col)) if cond is not None else c(col)), F.lit(0))

    return parts.groupBy(*PAIR, *described).agg(
        s("i_rows").alias("n_i"),
        F.count(F.when(has_inv, F.lit(1))).alias("invoice_freq"),
        s("i_amt_p", has_inv).alias("a_p"),
        s("i_amt_u", has_inv).alias("a_u"),
        s("i_amt_u_lt", has_inv).alias("a_u_lt"),
        s("i_amt_u_ge", has_inv).alias("a_u_ge"),
        F.abs(s("i_t_u", has_inv)).alias("t_u"),
        F.abs(s("i_t_u_lt", has_inv)).alias("t_u_lt"),
        F.abs(s("i_t_u_ge", has_inv)).alias("t_u_ge"),
        s("i_p_rows").alias("p_rows"), s("i_u_rows").alias("u_rows"), s("i_u_ge_rows").alias("u_ge_rows"),
        F.abs(s("i_e_sum")).alias("e_amt"), s("i_e1_rows").alias("e1_rows"), s("i_e1_days").alias("e1_days"),
        s("i_pc_num").alias("pc_num"), s("i_dbt_num").alias("dbt_num"), s("i_pc_den").alias("pc_den"),
        s("i_pc_rows").alias("pc_rows"),
        _days_sum(F.datediff(F.lit(p.processing_date), c("i_u_due")), c("i_amt_u"), has_inv & (c("i_u_rows") > 0)).alias("ag_num"),
        F.sum(F.when(has_inv & (c("i_u_rows") > 0), c("i_amt_u"))).alias("ag_den"),
        s("i_l1_le10_rows").alias("l1_le10_rows"), s("i_l1_gt10_rows").alias("l1_gt10_rows"),
        F.abs(s("i_l_le10_sum")).alias("l_le10_amt"), s("i_l_le10_rows").alias("l_le10_rows"),
        s("i_l_le10_days").alias("l_le10_days"),
        F.abs(s("i_l_gt10_sum")).alias("l_gt10_amt"), s("i_l_gt10_rows").alias("l_gt10_rows"),
        s("i_l_gt10_days").alias("l_gt10_days"),
        F.max("i_terms_max").alias("terms_max"),
        s("cb_rows").alias("chargeback_freq"), s("cb_total_abs").alias("cb_total_abs"),
        s("cb_paid_part").alias("cb_paid_part"), s("cb_open_abs").alias("cb_open_abs"),
        s("cb_overdue").alias("cb_overdue"), s("cb_early").alias("cb_early"),
        s("cb_early_rows").alias("cb_early_rows"), s("cb_open_rows").alias("open_chargeback_freq"),
        s("cb_open_total").alias("cb_open_total"), s("cb_closed_rows").alias("cb_closed_rows"),
        F.max("cb_on_time").alias("any_on_time"), F.max("cb_late").alias("any_late"),
    )


def described_pairs(ledger: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``pair_aggregate`` with each customer's attributes.

    The rows of all but the largest customers are dealt by customer, and everything about a customer is made there without another shuffle.  The rows are
    sorted by pair once and take their pair's description, the largest of each string, so that it is a grouping key: a maximum of strings would turn the
    wide aggregates from hash into sort aggregates.  The group is the highest real group id (the -1 sentinel only when there is none).  A largest
    customer's rows are combined by each map task for the numbers, and the few such customers' attributes are told to every task.
    """
    few, many = dealt(ledger, ["customer_id"])
    same = Window.partitionBy("customer_id")
    group = {"ndg_name": F.max_by("ndg_name", "ndg_id").over(same),
             **{c: F.max(c).over(same) for c in ("ndg_id", "customer_name", "customer_type_id", "customer_type")}}
    rows = few.withColumn("supplier_name", F.max("client_name").over(Window.partitionBy(*PAIR))).withColumns(group)
    few_pairs = pair_aggregate(rows, p, DESCRIPTION)
    names = many.select(*PAIR, "client_name").distinct().groupBy(*PAIR).agg(F.max("client_name").alias("supplier_name"))
    many_pairs = (pair_aggregate(many, p).join(names, PAIR, "left")
                  .join(F.broadcast(customer_attributes(many)), "customer_id", "left"))
    return few_pairs.unionByName(many_pairs)


def pair_metrics(ledger: DataFrame, p: Params = DEFAULT, attributes: DataFrame | None = None) -> DataFrame:
    """All pair metrics (one row per customer-supplier pair seen in the window)."""
    c = F.col
    agg = described_pairs(ledger, p)
    has_i, has_cb = c("n_i") > 0, c("chargeback_freq") > 0
    m2 = c("a_p") + c("a_u")
    total_ar = c("a_u") - c("t_u")

    def inv_metric(expr: Column) -> Column:
        return F.when(has_i, expr).otherwise(F.lit(0)).cast("double")

    def cb_metric(expr: Column) -> Column:
        return F.when(has_cb, expr).otherwise(F.lit(0)).cast("double")

    aging = F.bround(F.try_divide(c("ag_num").cast("double"), c("ag_den").cast("double")), 0)
    gt10_days = F.when(c("l_gt10_rows") > 0, F.floor(c("l_gt10_days") / c("l_gt10_rows"))).otherwise(0)
    # The global chargeback figures are derived from the pair aggregate, which is
    # persisted (memory, spilling to disk; rebuilt from lineage if an executor is
    # lost) so the ledger is aggregated once.
    agg = agg.persist(StorageLevel.MEMORY_AND_DISK)
    overdue = overdue_cb_suppliers(agg)
    out = agg.crossJoin(F.broadcast(overdue)).select(
        *PAIR, *DESCRIPTION,
        c("invoice_freq").cast("long").alias("invoice_freq"),
        inv_metric(from_units(m2)).alias("total_invoice"),
        inv_metric(_pct(c("a_p") + c("t_u"), m2)).alias("paid_invoice"),
        inv_metric(_pct(total_ar, m2)).alias("unpaid_invoice"),
        inv_metric(F.when(c("e1_rows") > 0, _pct(c("e_amt"), m2)).otherwise(0)).alias("early_payment_perc"),
        inv_metric(F.when(c("e1_rows") > 0, from_units(c("e_amt"))).otherwise(0)).alias("early_payment_amount"),
        inv_metric(F.when(c("e1_rows") > 0, F.floor(c("e1_days") / c("e1_rows"))).otherwise(0))
        .alias("early_payment_days"),
        inv_metric(from_units(c("a_u_lt") - c("t_u_lt"))).alias("open_ar"),
        inv_metric(F.when(c("u_rows") > 0, F.when(aging <= 10, F.lit(0.0)).otherwise(aging)).otherwise(0))
        .alias("aging_balance"),
        inv_metric(F.when(c("u_ge_rows") > 0, from_units(c("a_u_ge") - c("t_u_ge"))).otherwise(0))
        .alias("outstanding_balance"),
        inv_metric(F.when(c("p_rows") > 0, _pct(c("e1_rows"), c("p_rows"))).otherwise(0))
        .alias("payment_timeliness_ratio"),
        inv_metric(F.when(c("l1_le10_rows") > 0, _pct(c("l1_le10_rows"), c("p_rows"))).otherwise(0))
        .alias("late_payment_ratio_lt10"),
        inv_metric(F.when(c("l1_gt10_rows") > 0, _pct(c("l1_gt10_rows"), c("p_rows"))).otherwise(0))
        .alias("late_payment_ratio_gt10"),
        inv_metric(F.when((c("p_rows") > 0) & (c("pc_rows") > 0),
                          F.bround(F.try_divide(c("dbt_num").cast("double"), c("pc_den").cast("double")), 0))
                   .otherwise(0)).alias("dbt"),
        inv_metric(F.when((c("p_rows") > 0) & (c("pc_rows") > 0),
                          F.bround(F.try_divide(c("pc_num").cast("double"), c("pc_den").cast("double")), 0))
                   .otherwise(0)).alias("payment_cycle"),
        inv_metric(F.when(c("l_le10_rows") > 0, from_units(c("l_le10_amt"))).otherwise(0))
        .alias("delinquent_payment_lt10"),
        inv_metric(F.when(c("l_le10_rows") > 0, F.floor(c("l_le10_days") / c("l_le10_rows"))).otherwise(0))
        .alias("delinquent_overdueday_lt10"),
        inv_metric(F.when(c("l_gt10_rows") > 0, from_units(c("l_gt10_amt"))).otherwise(0))
        .alias("delinquent_payment_gt10"),
        inv_metric(gt10_days).alias("delinquent_overdueday_gt10"),
        inv_metric(c("terms_max") + gt10_days).alias("payment_predictor"),
        (F.when(has_i, 1).otherwise(0) + F.when(has_cb, 1).otherwise(0)).cast("long").alias("suppliers_freq"),
        c("chargeback_freq").cast("long").alias("chargeback_freq"),
        cb_metric(from_units(c("cb_total_abs"))).alias("chargeback_vol_amt"),
        cb_metric(from_units(c("cb_paid_part"))).alias("chargeback_vol_paid"),
        cb_metric(from_units(c("cb_open_abs"))).alias("chargeback_vol_unpaid"),
        F.when(has_cb, c("supplier_wo_overdue_cb")).otherwise(0).cast("long").alias("supplier_wo_overdue_cb"),
        F.when(has_cb, c("supplier_w_overdue_cb")).otherwise(0).cast("long").alias("supplier_w_overdue_cb"),
        cb_metric(from_units(c("cb_overdue"))).alias("overdue_chargebacks"),
        cb_metric(from_units(c("cb_early"))).alias("early_chargeback"),
        cb_metric(F.when(c("cb_closed_rows") > 0, _pct(c("cb_early_rows"), c("cb_closed_rows"))).otherwise(0))
        .alias("timeliness_of_chargeback"),
        (inv_metric(from_units(total_ar)) - cb_metric(from_units(c("cb_open_abs")))).alias("risk_balance"),
        F.when((c("invoice_freq") != 0) & (c("invoice_freq") > c("chargeback_freq")),
               _pct(c("invoice_freq") - (c("chargeback_freq") - c("open_chargeback_freq")), c("invoice_freq")))
        .otherwise(0).cast("double").alias("w_o_open_cb"),
        inv_metric(from_units(total_ar)).alias("total_ar"),
        inv_metric(F.when(c("l_le10_rows") > 0, _pct(c("l_le10_amt"), m2)).otherwise(0)).alias("payment1_percent"),
        inv_metric(F.when(c("l_gt10_rows") > 0, _pct(c("l_gt10_amt"), m2)).otherwise(0)).alias("payment2_percent"),
        c("open_chargeback_freq").cast("long").alias("open_chargeback_freq"),
        cb_metric(from_units(c("cb_open_total"))).alias("open_chargeback_vol_amt"),
        F.when(c("u_rows") > 0, 1).otherwise(0).cast("long").alias("num_supplier_w_open_invoice"),
        inv_metric(F.lit(0.01)).alias("payment2_percent_wo_cb"),
    )
    if attributes is not None:
        out = out.drop(*[a for a in attributes.columns if a != "customer_id"]).join(attributes, "customer_id", "left")
    return out.select(*ATTRIBUTE_COLUMNS, *METRIC_COLUMNS)
