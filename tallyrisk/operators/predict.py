"""Cash-collection predictor over a horizon of H days."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import from_units, units
from ..params import DEFAULT, Params

PAIR = ["customer_id", "supplier_id"]
_NO_DATE = _dt.date(1900, 1, 1)


def horizon_invoices(ledger: DataFrame, horizon: int, p: Params = DEFAULT, dates: tuple[str, ...] = ("duedate",)) -> DataFrame:
    """Open invoice rows due in ``(D - 10, D + horizon]`` — one row per invoice, with the earliest of each of its ``dates``.

    ``paid_u`` is what was already paid on the invoice by D (a missing payment
    date counts as paid long ago), in money units.
    """
    D = F.lit(p.processing_date)
    due_in = F.datediff(F.col("duedate"), D)
    rows = ledger.filter((F.col("ispaid") == 0) & (due_in > -10) & (due_in <= horizon)
                         & F.col("invoice_num").isNotNull())
    paid_by_d = F.coalesce(F.col("txn_date"), F.lit(_NO_DATE)) <= D
    return rows.groupBy(*PAIR, "invoice_num").agg(
        *[F.min(d).alias(d) for d in dates],
        F.max("invoice_amount").alias("invoice_amount"),
        F.sum(F.when(paid_by_d, units("txn_amount"))).alias("paid_u"),
    )


def _moved(due: str, days: str, sign: int) -> Column:
    return F.date_add(F.col(due), (F.col(days) * sign).cast("int"))


def _share(pct: Column, amount: Column, date: Column, last: Column) -> Column:
    """The part of an invoice expected by ``date``, if that is not after ``last``."""
    return F.when(date <= last, pct * amount / 100)


def _open_units(parts: list[Column], paid_u: Column) -> Column:
    """Expected parts less what was paid, in money units, floored at 0."""
    expected = F.coalesce(parts[0], F.lit(0.0)) + F.coalesce(parts[1], F.lit(0.0)) + F.coalesce(parts[2], F.lit(0.0))
    return F.greatest(units(expected) - F.abs(F.coalesce(paid_u, F.lit(0))), F.lit(0))


_DATES = ("early_payment_date", "late_lt10_date", "late_gt10_date")


_NAMES = ("customer_name", "supplier_name", "ndg_name", "customer_type")


def _expected(ledger: DataFrame, pair_metrics: DataFrame, horizon: int, p: Params, names: tuple[str, ...] = ()) -> DataFrame:
    """Open invoices of the horizon with their pair's shares (and names), expected dates and predicted collection (in money units)."""
    last = F.lit(p.processing_date + _dt.timedelta(days=horizon - 1))
    hist = pair_metrics.select(*PAIR, *names, "early_payment_perc", "payment1_percent", "payment2_percent", "early_payment_days",
                               "delinquent_overdueday_lt10", "delinquent_overdueday_gt10")
    dates = ("duedate", "invoice_date") if names else ("duedate",)
    inv = horizon_invoices(ledger, horizon, p, dates).join(hist, PAIR, "left")
    amt = F.col("invoice_amount")

    dates = [_moved("duedate", "early_payment_days", -1), _moved("duedate", "delinquent_overdueday_lt10", 1),
             _moved("duedate", "delinquent_overdueday_gt10", 1)]
    shares = (F.abs("early_payment_perc"), F.col("payment1_percent"), F.col("payment2_percent"))
    parts = [_share(pct, amt, date, last) for pct, date in zip(shares, dates)]
    return inv.select("*", *[d.alias(n) for d, n in zip(dates, _DATES)],
                      *[(pct * amt / 100).alias(n) for pct, n in zip(shares, ("early_share", "lt10_share", "gt10_share"))],
                      from_units(F.coalesce(F.col("paid_u"), F.lit(0))).alias("paid_amount"),
                      _open_units(parts, F.col("paid_u")).alias("predicted_u"))


def predict_invoices(ledger: DataFrame, pair_metrics: DataFrame, horizon: int, p: Params = DEFAULT) -> DataFrame:
    """Expected collection per open invoice within the horizon.

    The invoice amount is split by the pair's history into an early share (due
    date minus the usual early days), a late share paid within 10 days and one
    paid later (due date plus the usual overdue days); a share counts when its
    expected date is on or before ``D + horizon - 1``.  What was already paid is
    subtracted and the result floored at 0.
    """
    return _expected(ledger, pair_metrics, horizon, p).select(
        *PAIR, "invoice_num", "duedate", "invoice_amount", "paid_amount", *_DATES, "predicted_u")


def predict_invoice_detail(ledger: DataFrame, pair_metrics: DataFrame, horizon: int, p: Params = DEFAULT) -> DataFrame:
    """``predict_invoices`` as published: with names, and the amount of each of the three shares whether or not it falls within the horizon."""
    return _expected(ledger, pair_metrics, horizon, p, _NAMES).select(
        "invoice_num", *PAIR, "supplier_name", "customer_name", "ndg_name", "customer_type", "duedate", "invoice_amount", "invoice_date",
        "paid_amount", "early_share", "lt10_share", "gt10_share", *_DATES, from_units("predicted_u").alias(f"predicted_{horizon}d"))


def predict_open_pairs(ledger: DataFrame, pair_metrics: DataFrame, horizons=(10, 30), p: Params = DEFAULT,
                       carried: tuple[str, ...] = ("ndg_id",)) -> DataFrame:
    """Expected collections of the pairs that have open invoices due, for several horizons in one pass, with what is ``carried`` of ``pair_metrics``.

    The rows due within the widest horizon are grouped by invoice once, with every horizon's own rows inside
    conditional aggregates: an invoice's due date, amount and payments come from the rows due within that
    horizon, as in ``predict_invoices``.
    """
    D = F.lit(p.processing_date)
    due_in = F.datediff(F.col("duedate"), D)
    rows = ledger.filter((F.col("ispaid") == 0) & (due_in > -10) & (due_in <= max(horizons)) & F.col("invoice_num").isNotNull())
    paid_by_d = F.coalesce(F.col("txn_date"), F.lit(_NO_DATE)) <= D
    aggs = []
    for h in horizons:
        inside = due_in <= h
        aggs += [F.min(F.when(inside, F.col("duedate"))).alias(f"due_{h}"),
                 F.max(F.when(inside, F.col("invoice_amount"))).alias(f"amount_{h}"),
                 F.sum(F.when(inside & paid_by_d, units("txn_amount"))).alias(f"paid_{h}")]
    shares = pair_metrics.select(*PAIR, *carried, "early_payment_perc", "payment1_percent", "payment2_percent", "early_payment_days",
                                 "delinquent_overdueday_lt10", "delinquent_overdueday_gt10")
    inv = rows.groupBy(*PAIR, "invoice_num").agg(*aggs).join(shares, PAIR)
    sums = []
    for h in horizons:
        last = F.lit(p.processing_date + _dt.timedelta(days=h - 1))
        parts = [_share(F.abs("early_payment_perc"), F.col(f"amount_{h}"), _moved(f"due_{h}", "early_payment_days", -1), last),
                 _share(F.col("payment1_percent"), F.col(f"amount_{h}"), _moved(f"due_{h}", "delinquent_overdueday_lt10", 1), last),
                 _share(F.col("payment2_percent"), F.col(f"amount_{h}"), _moved(f"due_{h}", "delinquent_overdueday_gt10", 1), last)]
        sums.append(F.sum(F.when(F.col(f"due_{h}").isNotNull(), _open_units(parts, F.col(f"paid_{h}")))).alias(f"__p{h}"))
    per_pair = inv.groupBy(*PAIR).agg(*[F.max(c).alias(c) for c in carried], *sums)
    return per_pair.select(*PAIR, *carried, *[from_units(F.coalesce(F.col(f"__p{h}"), F.lit(0))).alias(f"predict_ar_{h}d") for h in horizons])


def with_predictions(pairs: DataFrame, predicted: DataFrame, horizons=(10, 30)) -> DataFrame:
    """Pairs with their expected collections: those of ``predict_open_pairs``, 0 for the other pairs."""
    cols = [f"predict_ar_{h}d" for h in horizons]
    j = pairs.join(predicted.select(*PAIR, *[F.col(c).alias("__" + c) for c in cols]), PAIR, "left")
    return j.select(*pairs.columns, *[F.coalesce(F.col("__" + c), F.lit(0.0)).alias(c) for c in cols])


def stacked_predictions(pairs: DataFrame, predicted: DataFrame, horizons=(10, 30)) -> DataFrame:
    """Rows whose sums by customer or group are those of ``with_predictions``, without its join: every pair with no prediction, and below them the pairs
    of ``predict_open_pairs`` with nothing but ids and predictions.  Sums, means and maxima leave the nulls out; rows are not to be counted."""
    nothing = {f"predict_ar_{h}d": F.lit(0.0) for h in horizons}
    return pairs.withColumns(nothing).unionByName(predicted, allowMissingColumns=True)


def predict_pairs(ledger: DataFrame, pair_metrics: DataFrame, horizons=(10, 30), p: Params = DEFAULT) -> DataFrame:
    """Expected collections per pair (0 for pairs without open invoices) for several horizons in one pass."""
    return with_predictions(pair_metrics.select(*PAIR), predict_open_pairs(ledger, pair_metrics, horizons, p, ()), horizons)
