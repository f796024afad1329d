import datetime as dt

from pyspark.sql import functions as F

from tallyrisk.operators import clean, metrics
from tallyrisk.params import Params

D = dt.date(2001, 8, 1)
P = Params(processing_date=D)

INV_COLS = ("supplier_id long, client_name string, invoice_date date, invoice_num long, ndg_id long, ndg_name string, "
            "customer_id long, customer_name string, customer_type_id int, customer_type string, ispaid int, "
            "balance double, invoice_amount double, txn_amount double, txn_date date, memo string, txn_type string, "
            "duedate date")
CB_COLS = ("reference_num long, supplier_id long, client_name string, ndg_id long, ndg_name string, customer_id long, "
           "customer_type_id int, customer_type string, customer_name string, total_amount double, "
           "open_balance double, paid_amount double, bill_date date, cb_duedate date, paid_date date")


def d(n):
    return D - dt.timedelta(days=n)


def inv(spark, rows):
    full = [(1, "S1", r[0], r[1], 7, "G", 10, "C10", 1, "BUILDING", r[2], 0.0, r[3], r[4], r[5], r[6], r[7], r[8])
            for r in rows]
    return spark.createDataFrame(full, INV_COLS)


def cbs(spark, rows):
    return spark.createDataFrame([(i, 1, "S1", 7, "G", 10, 1, "BUILDING", "C10") + r for i, r in enumerate(rows)],
                                 CB_COLS)


def run(spark, invoices, chargebacks):
    return metrics.pair_metrics(clean.unified_ledger(invoices, chargebacks, P), P).collect()


def test_paid_and_unpaid_invoice(spark):
    # invoice 100: paid, 1000, paid 1000 five days before due; invoice 200: unpaid 500, 200 paid late (3 days)
    rows = [
        (d(60), 100, 1, 1000.0, -1000.0, d(35), None, "Payment", d(30)),
        (d(40), 200, 0, 500.0, -200.0, d(7), None, "Payment", d(10)),
    ]
    (r,) = run(spark, inv(spark, rows), cbs(spark, []))
    assert r.invoice_freq == 2
    assert r.total_invoice == 1500.0
    assert r.total_ar == 300.0            # 500 - 200 paid by D
    assert r.open_ar == 300.0             # due before D
    assert abs(r.paid_invoice - (1000 + 200) / 1500 * 100) < 1e-12
    assert abs(r.unpaid_invoice - 300 / 1500 * 100) < 1e-12
    assert r.payment_timeliness_ratio == 100.0
    assert r.early_payment_amount == 1000.0 and r.early_payment_days == 5
    assert r.delinquent_payment_lt10 == 200.0 and r.delinquent_overdueday_lt10 == 3
    assert r.payment_cycle == 25.0 and r.dbt == -5.0
    assert r.aging_balance == 0.0         # 10 days overdue -> not above 10
    assert r.outstanding_balance == 0.0
    assert r.chargeback_freq == 0 and r.risk_balance == 300.0
    assert r.payment2_percent_wo_cb == 0.01 and r.suppliers_freq == 1


def test_chargeback_only_pair_has_zero_invoice_metrics(spark):
    cb = cbs(spark, [(-10.0, 10.0, 2.0, d(50), d(20), None), (-5.0, 0.0, 5.0, d(50), d(20), d(30))])
    (r,) = run(spark, inv(spark, []), cb)
    assert r.invoice_freq == 0 and r.total_invoice == 0.0 and r.payment2_percent_wo_cb == 0.0
    assert r.chargeback_freq == 2 and r.chargeback_vol_amt == 15.0 and r.chargeback_vol_unpaid == 10.0
    assert r.overdue_chargebacks == 2.0 and r.early_chargeback == 5.0 and r.timeliness_of_chargeback == 100.0
    assert r.open_chargeback_freq == 1 and r.risk_balance == -10.0 and r.suppliers_freq == 1
    assert r.supplier_wo_overdue_cb == 1 and r.supplier_w_overdue_cb == 0


def test_null_due_date_defaults_to_30_days(spark):
    rows = [(d(100), 300, 1, 100.0, -100.0, d(60), None, "Payment", None)]
    (r,) = run(spark, inv(spark, rows), cbs(spark, []))
    assert r.dbt == 10.0                  # due = invoice + 30 = d(70); paid d(60), 10 days late


def test_early_advance_and_full_credit_memo(spark):
    rows = [
        (d(10), 1, 0, 50.0, -50.0, d(5), "EARLY PAYMENT ADVANCEMENT", "Payment", d(1)),   # single row -> txn 0
        (d(10), 2, 0, 80.0, -80.0, d(5), None, "CreditMemo", d(1)),                       # full memo -> dropped
        (d(10), 3, 0, 90.0, -10.0, d(5), "early payment advancement", "Payment", d(1)),   # invoice seen twice
        (d(10), 3, 0, 90.0, -20.0, d(4), None, "Payment", d(1)),
        (d(10), None, 0, 70.0, -70.0, d(5), "early payment advancement", "Payment", d(1)),  # null invoice kept
    ]
    out = clean.clean_invoices(inv(spark, rows), P).orderBy("invoice_num", "txn_amount").collect()
    got = [(r.invoice_num, r.txn_amount) for r in out]
    assert got == [(None, -70.0), (1, 0.0), (3, -20.0), (3, -10.0)]


def test_permutation_invariance(spark):
    from tallyrisk.sources.tables import Tables
    from conftest import SF_SMALL
    t = Tables(spark, SF_SMALL)
    base = metrics.pair_metrics(clean.unified_ledger(t.invoice_payments, t.chargebacks))
    shuffled = metrics.pair_metrics(clean.unified_ledger(t.invoice_payments.orderBy(F.rand(7)).repartition(5),
                                                         t.chargebacks.orderBy(F.rand(3))))
    assert base.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(base).count() == 0
