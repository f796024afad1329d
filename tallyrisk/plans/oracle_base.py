"""Shared SQL building blocks of the DuckDB oracle.

These are written directly in SQL, independently of the DataFrame code, so an
oracle match checks the Spark operators against a second formulation.
"""
from __future__ import annotations

from ..params import DEFAULT
from ..sources.fixtures import oracle_text

D = f"DATE '{DEFAULT.processing_date.isoformat()}'"
D0 = f"DATE '{DEFAULT.window_start.isoformat()}'"


def U(x: str) -> str:
    """Amount in exact integer units (1e-4)."""
    return f"CAST(round(({x}) * 10000) AS BIGINT)"


def FU(x: str) -> str:
    return f"(CAST(({x}) AS DOUBLE) / 10000)"


def with_fixtures(*names: str, extra: list[tuple[str, str]] = ()) -> str:
    parts = [f"{n} AS ({oracle_text(n)})" for n in names] + [f"{n} AS ({q})" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n"


LEDGER_CTES = [
    ("inv_w", f"SELECT * FROM invoice_payments WHERE invoice_date BETWEEN {D0} AND {D}"),
    ("inv_a", """SELECT * REPLACE (CASE WHEN coalesce(memo ILIKE '%early payment advancement%', false)
                    AND invoice_num IS NOT NULL AND count(*) OVER (PARTITION BY invoice_num) = 1
                    THEN 0.0 ELSE txn_amount END AS txn_amount) FROM inv_w"""),
    ("inv_c", """SELECT * FROM inv_a
                 WHERE NOT coalesce(txn_type = 'CreditMemo' AND abs(txn_amount) = invoice_amount, false)"""),
    ("ledger", f"""
      SELECT src, customer_id, supplier_id, invoice_num, coalesce(ispaid, 2) AS ispaid, invoice_date,
             coalesce(duedate, invoice_date + 30) AS duedate, txn_date,
             coalesce(invoice_amount, 0) AS invoice_amount, coalesce(txn_amount, 0) AS txn_amount,
             coalesce(total_amount, 0) AS total_amount, coalesce(open_balance, 0) AS open_balance,
             coalesce(paid_amount, 0) AS paid_amount, bill_date, cb_duedate, paid_date,
             coalesce(ndg_id, -1) AS ndg_id, coalesce(ndg_name, 'None') AS ndg_name, customer_name,
             client_name, customer_type_id, customer_type
      FROM (
        SELECT 'inv' AS src, customer_id, supplier_id, invoice_num, ispaid, invoice_date, duedate, txn_date,
               invoice_amount, txn_amount, NULL::DOUBLE AS total_amount, NULL::DOUBLE AS open_balance,
               NULL::DOUBLE AS paid_amount, NULL::DATE AS bill_date, NULL::DATE AS cb_duedate,
               NULL::DATE AS paid_date, ndg_id, ndg_name, customer_name, client_name, customer_type_id,
               customer_type
        FROM inv_c
        UNION ALL
        SELECT 'cb', customer_id, supplier_id, NULL, 2, NULL, NULL, NULL, NULL, NULL, total_amount,
               open_balance, paid_amount, bill_date, cb_duedate, paid_date, ndg_id, ndg_name, customer_name,
               client_name, customer_type_id, customer_type
        FROM chargebacks WHERE bill_date BETWEEN {D0} AND {D}
      ) x
      WHERE customer_id IS NOT NULL AND supplier_id IS NOT NULL"""),
]


def ledger_prefix(extra: list[tuple[str, str]] = (), fixtures: tuple[str, ...] = ()) -> str:
    return with_fixtures("invoice_payments", "chargebacks", *fixtures, extra=LEDGER_CTES + list(extra))


PAIR_CTES = [
    ("lv1", f"""
      SELECT customer_id, supplier_id, invoice_num,
        count(*) AS n_rows,
        count(*) FILTER (WHERE ispaid = 1) AS p_rows,
        count(*) FILTER (WHERE ispaid = 0) AS u_rows,
        count(*) FILTER (WHERE ispaid = 0 AND duedate >= {D}) AS u_ge_rows,
        CAST(round(avg({U('invoice_amount')}) FILTER (WHERE ispaid = 1)) AS BIGINT) AS amt_p,
        CAST(round(avg({U('invoice_amount')}) FILTER (WHERE ispaid = 0)) AS BIGINT) AS amt_u,
        CAST(round(avg({U('invoice_amount')}) FILTER (WHERE ispaid = 0 AND duedate < {D})) AS BIGINT) AS amt_u_lt,
        CAST(round(avg({U('invoice_amount')}) FILTER (WHERE ispaid = 0 AND duedate >= {D})) AS BIGINT) AS amt_u_ge,
        min(duedate) FILTER (WHERE ispaid = 0) AS u_due,
        sum({U('txn_amount')}) FILTER (WHERE ispaid = 0 AND txn_date <= {D}) AS t_u,
        sum({U('txn_amount')}) FILTER (WHERE ispaid = 0 AND duedate < {D} AND txn_date <= {D}) AS t_u_lt,
        sum({U('txn_amount')}) FILTER (WHERE ispaid = 0 AND duedate >= {D} AND txn_date <= {D}) AS t_u_ge,
        sum({U('txn_amount')}) FILTER (WHERE (ispaid = 1 AND txn_date <= duedate)
                                       OR (ispaid = 0 AND txn_date <= duedate AND txn_date <= {D})) AS e_sum,
        count(*) FILTER (WHERE ispaid = 1 AND txn_date <= duedate) AS e1_rows,
        sum(date_diff('day', txn_date, duedate)) FILTER (WHERE ispaid = 1 AND txn_date <= duedate) AS e1_days,
        sum(date_diff('day', invoice_date, txn_date) * {U('txn_amount')})
            FILTER (WHERE ispaid = 1 AND txn_date IS NOT NULL) AS pc_num,
        sum(date_diff('day', duedate, txn_date) * {U('txn_amount')})
            FILTER (WHERE ispaid = 1 AND txn_date IS NOT NULL) AS dbt_num,
        sum({U('txn_amount')}) FILTER (WHERE ispaid = 1 AND txn_date IS NOT NULL) AS pc_den,
        count(*) FILTER (WHERE ispaid = 1 AND txn_date IS NOT NULL) AS pc_rows,
        count(*) FILTER (WHERE ispaid = 1 AND txn_date > duedate AND date_diff('day', duedate, txn_date) <= 10)
            AS l1_le10,
        count(*) FILTER (WHERE ispaid = 1 AND txn_date > duedate AND date_diff('day', duedate, txn_date) > 10)
            AS l1_gt10,
        sum({U('txn_amount')}) FILTER (WHERE late AND date_diff('day', duedate, txn_date) <= 10) AS l_le10_sum,
        count(*) FILTER (WHERE late AND date_diff('day', duedate, txn_date) <= 10) AS l_le10_rows,
        sum(date_diff('day', duedate, txn_date)) FILTER (WHERE late AND date_diff('day', duedate, txn_date) <= 10)
            AS l_le10_days,
        sum({U('txn_amount')}) FILTER (WHERE late AND date_diff('day', duedate, txn_date) > 10) AS l_gt10_sum,
        count(*) FILTER (WHERE late AND date_diff('day', duedate, txn_date) > 10) AS l_gt10_rows,
        sum(date_diff('day', duedate, txn_date)) FILTER (WHERE late AND date_diff('day', duedate, txn_date) > 10)
            AS l_gt10_days,
        max(date_diff('day', invoice_date, duedate)) AS terms_max
      FROM (SELECT *, coalesce((ispaid = 1 AND txn_date > duedate)
                               OR (ispaid = 0 AND txn_date > duedate AND txn_date <= {D}), false) AS late
            FROM ledger WHERE ispaid IN (0, 1)) r
      GROUP BY customer_id, supplier_id, invoice_num"""),
    ("iv", """
      SELECT customer_id, supplier_id,
        sum(n_rows) AS n_i,
        count(*) FILTER (WHERE invoice_num IS NOT NULL) AS invoice_freq,
        coalesce(sum(amt_p) FILTER (WHERE invoice_num IS NOT NULL), 0) AS a_p,
        coalesce(sum(amt_u) FILTER (WHERE invoice_num IS NOT NULL), 0) AS a_u,
        coalesce(sum(amt_u_lt) FILTER (WHERE invoice_num IS NOT NULL), 0) AS a_u_lt,
        coalesce(sum(amt_u_ge) FILTER (WHERE invoice_num IS NOT NULL), 0) AS a_u_ge,
        abs(coalesce(sum(t_u) FILTER (WHERE invoice_num IS NOT NULL), 0)) AS t_u,
        abs(coalesce(sum(t_u_lt) FILTER (WHERE invoice_num IS NOT NULL), 0)) AS t_u_lt,
        abs(coalesce(sum(t_u_ge) FILTER (WHERE invoice_num IS NOT NULL), 0)) AS t_u_ge,
        sum(p_rows) AS p_rows, sum(u_rows) AS u_rows, sum(u_ge_rows) AS u_ge_rows,
        abs(coalesce(sum(e_sum), 0)) AS e_amt, sum(e1_rows) AS e1_rows, coalesce(sum(e1_days), 0) AS e1_days,
        coalesce(sum(pc_num), 0) AS pc_num, coalesce(sum(dbt_num), 0) AS dbt_num,
        coalesce(sum(pc_den), 0) AS pc_den, sum(pc_rows) AS pc_rows,
        sum(date_diff('day', u_due, DATE '{D_}') * amt_u) FILTER (WHERE invoice_num IS NOT NULL AND u_rows > 0) AS ag_num,
        sum(amt_u) FILTER (WHERE invoice_num IS NOT NULL AND u_rows > 0) AS ag_den,
        sum(l1_le10) AS l1_le10, sum(l1_gt10) AS l1_gt10,
        abs(coalesce(sum(l_le10_sum), 0)) AS l_le10_amt, sum(l_le10_rows) AS l_le10_rows,
        coalesce(sum(l_le10_days), 0) AS l_le10_days,
        abs(coalesce(sum(l_gt10_sum), 0)) AS l_gt10_amt, sum(l_gt10_rows) AS l_gt10_rows,
        coalesce(sum(l_gt10_days), 0) AS l_gt10_days,
        max(terms_max) AS terms_max
      FROM lv1 GROUP BY customer_id, supplier_id""".replace("{D_}", DEFAULT.processing_date.isoformat())),
    ("cbp", f"""
      SELECT customer_id, supplier_id,
        count(*) AS cb_freq,
        sum(abs({U('total_amount')})) AS cb_total_abs,
        sum(abs({U('total_amount')}) - {U('open_balance')}) AS cb_paid_part,
        sum(abs({U('open_balance')})) AS cb_open_abs,
        coalesce(sum(abs({U('paid_amount')})) FILTER (WHERE open_balance <> 0 AND cb_duedate < {D}), 0) AS cb_overdue,
        coalesce(sum(abs({U('paid_amount')})) FILTER (WHERE open_balance = 0 AND paid_date <= cb_duedate), 0) AS cb_early,
        count(*) FILTER (WHERE open_balance = 0 AND paid_date <= cb_duedate) AS cb_early_rows,
        count(*) FILTER (WHERE open_balance <> 0) AS cb_open_rows,
        coalesce(sum(abs({U('total_amount')})) FILTER (WHERE open_balance <> 0), 0) AS cb_open_total,
        count(*) FILTER (WHERE open_balance = 0) AS cb_closed_rows
      FROM ledger WHERE src = 'cb' GROUP BY customer_id, supplier_id"""),
    ("gcb", """
      SELECT count(DISTINCT supplier_id) FILTER (WHERE paid_date <= cb_duedate) AS wo,
             count(DISTINCT supplier_id) FILTER (WHERE paid_date > cb_duedate) AS w
      FROM ledger WHERE src = 'cb'"""),
    ("snames", "SELECT customer_id, supplier_id, max(client_name) AS supplier_name FROM ledger GROUP BY 1, 2"),
    ("cattr", """
      SELECT customer_id, max(ndg_id) AS ndg_id, arg_max(ndg_name, ndg_id) AS ndg_name,
             max(customer_name) AS customer_name, max(customer_type_id) AS customer_type_id,
             max(customer_type) AS customer_type
      FROM ledger GROUP BY customer_id"""),
    ("pair_metrics", """
      SELECT a.ndg_id, a.ndg_name, k.customer_id, k.supplier_id, a.customer_name, sn.supplier_name,
        a.customer_type_id, a.customer_type,
        CAST(coalesce(iv.invoice_freq, 0) AS BIGINT) AS invoice_freq,
        CASE WHEN iv.n_i > 0 THEN CAST(a_p + a_u AS DOUBLE) / 10000 ELSE 0 END AS total_invoice,
        CASE WHEN iv.n_i > 0 THEN CAST(a_p + t_u AS DOUBLE) / nullif(CAST(a_p + a_u AS DOUBLE), 0) * 100 ELSE 0 END
          AS paid_invoice,
        CASE WHEN iv.n_i > 0 THEN CAST(a_u - t_u AS DOUBLE) / nullif(CAST(a_p + a_u AS DOUBLE), 0) * 100 ELSE 0 END
          AS unpaid_invoice,
        CASE WHEN iv.n_i > 0 AND e1_rows > 0 THEN CAST(e_amt AS DOUBLE) / nullif(CAST(a_p + a_u AS DOUBLE), 0) * 100
             ELSE 0 END AS early_payment_perc,
        CASE WHEN iv.n_i > 0 AND e1_rows > 0 THEN CAST(e_amt AS DOUBLE) / 10000 ELSE 0 END AS early_payment_amount,
        CASE WHEN iv.n_i > 0 AND e1_rows > 0 THEN floor(CAST(e1_days AS DOUBLE) / e1_rows) ELSE 0 END
          AS early_payment_days,
        CASE WHEN iv.n_i > 0 THEN CAST(a_u_lt - t_u_lt AS DOUBLE) / 10000 ELSE 0 END AS open_ar,
        CASE WHEN iv.n_i > 0 AND u_rows > 0 THEN
               CASE WHEN round_even(CAST(ag_num AS DOUBLE) / nullif(CAST(ag_den AS DOUBLE), 0), 0) <= 10 THEN 0
                    ELSE round_even(CAST(ag_num AS DOUBLE) / nullif(CAST(ag_den AS DOUBLE), 0), 0) END
             ELSE 0 END AS aging_balance,
        CASE WHEN iv.n_i > 0 AND u_ge_rows > 0 THEN CAST(a_u_ge - t_u_ge AS DOUBLE) / 10000 ELSE 0 END AS outstanding_balance,
        CASE WHEN iv.n_i > 0 AND p_rows > 0 THEN CAST(e1_rows AS DOUBLE) / p_rows * 100 ELSE 0 END
          AS payment_timeliness_ratio,
        CASE WHEN iv.n_i > 0 AND l1_le10 > 0 THEN CAST(l1_le10 AS DOUBLE) / p_rows * 100 ELSE 0 END
          AS late_payment_ratio_lt10,
        CASE WHEN iv.n_i > 0 AND l1_gt10 > 0 THEN CAST(l1_gt10 AS DOUBLE) / p_rows * 100 ELSE 0 END
          AS late_payment_ratio_gt10,
        CASE WHEN iv.n_i > 0 AND p_rows > 0 AND pc_rows > 0
             THEN round_even(CAST(dbt_num AS DOUBLE) / nullif(CAST(pc_den AS DOUBLE), 0), 0) ELSE 0 END AS dbt,
        CASE WHEN iv.n_i > 0 AND p_rows > 0 AND pc_rows > 0
             THEN round_even(CAST(pc_num AS DOUBLE) / nullif(CAST(pc_den AS DOUBLE), 0), 0) ELSE 0 END
          AS payment_cycle,
        CASE WHEN iv.n_i > 0 AND l_le10_rows > 0 THEN CAST(l_le10_amt AS DOUBLE) / 10000 ELSE 0 END AS delinquent_payment_lt10,
        CASE WHEN iv.n_i > 0 AND l_le10_rows > 0 THEN floor(CAST(l_le10_days AS DOUBLE) / l_le10_rows) ELSE 0 END
          AS delinquent_overdueday_lt10,
        CASE WHEN iv.n_i > 0 AND l_gt10_rows > 0 THEN CAST(l_gt10_amt AS DOUBLE) / 10000 ELSE 0 END AS delinquent_payment_gt10,
        CASE WHEN iv.n_i > 0 AND l_gt10_rows > 0 THEN floor(CAST(l_gt10_days AS DOUBLE) / l_gt10_rows) ELSE 0 END
          AS delinquent_overdueday_gt10,
        CASE WHEN iv.n_i > 0 THEN terms_max + CASE WHEN l_gt10_rows > 0
             THEN floor(CAST(l_gt10_days AS DOUBLE) / l_gt10_rows) ELSE 0 END ELSE 0 END AS payment_predictor,
        CAST((CASE WHEN iv.n_i > 0 THEN 1 ELSE 0 END) + (CASE WHEN cbp.cb_freq > 0 THEN 1 ELSE 0 END) AS BIGINT)
          AS suppliers_freq,
        CAST(coalesce(cb_freq, 0) AS BIGINT) AS chargeback_freq,
        coalesce(CAST(cb_total_abs AS DOUBLE) / 10000, 0) AS chargeback_vol_amt,
        coalesce(CAST(cb_paid_part AS DOUBLE) / 10000, 0) AS chargeback_vol_paid,
        coalesce(CAST(cb_open_abs AS DOUBLE) / 10000, 0) AS chargeback_vol_unpaid,
        CAST(CASE WHEN cb_freq > 0 THEN gcb.wo ELSE 0 END AS BIGINT) AS supplier_wo_overdue_cb,
        CAST(CASE WHEN cb_freq > 0 THEN gcb.w ELSE 0 END AS BIGINT) AS supplier_w_overdue_cb,
        coalesce(CAST(cb_overdue AS DOUBLE) / 10000, 0) AS overdue_chargebacks,
        coalesce(CAST(cb_early AS DOUBLE) / 10000, 0) AS early_chargeback,
        CASE WHEN cb_closed_rows > 0 THEN CAST(cb_early_rows AS DOUBLE) / cb_closed_rows * 100 ELSE 0 END
          AS timeliness_of_chargeback,
        (CASE WHEN iv.n_i > 0 THEN CAST(a_u - t_u AS DOUBLE) / 10000 ELSE 0 END) - coalesce(CAST(cb_open_abs AS DOUBLE) / 10000, 0)
          AS risk_balance,
        CASE WHEN coalesce(iv.invoice_freq, 0) <> 0 AND iv.invoice_freq > coalesce(cb_freq, 0)
             THEN CAST(iv.invoice_freq - (coalesce(cb_freq, 0) - coalesce(cb_open_rows, 0)) AS DOUBLE)
                  / iv.invoice_freq * 100 ELSE 0 END AS w_o_open_cb,
        CASE WHEN iv.n_i > 0 THEN CAST(a_u - t_u AS DOUBLE) / 10000 ELSE 0 END AS total_ar,
        CASE WHEN iv.n_i > 0 AND l_le10_rows > 0 THEN CAST(l_le10_amt AS DOUBLE) / nullif(CAST(a_p + a_u AS DOUBLE), 0) * 100
             ELSE 0 END AS payment1_percent,
        CASE WHEN iv.n_i > 0 AND l_gt10_rows > 0 THEN CAST(l_gt10_amt AS DOUBLE) / nullif(CAST(a_p + a_u AS DOUBLE), 0) * 100
             ELSE 0 END AS payment2_percent,
        CAST(coalesce(cb_open_rows, 0) AS BIGINT) AS open_chargeback_freq,
        coalesce(CAST(cb_open_total AS DOUBLE) / 10000, 0) AS open_chargeback_vol_amt,
        CAST(CASE WHEN u_rows > 0 THEN 1 ELSE 0 END AS BIGINT) AS num_supplier_w_open_invoice,
        CASE WHEN iv.n_i > 0 THEN CAST(0.01 AS DOUBLE) ELSE 0 END AS payment2_percent_wo_cb
      FROM (SELECT DISTINCT customer_id, supplier_id FROM ledger) k
      LEFT JOIN iv USING (customer_id, supplier_id)
      LEFT JOIN cbp USING (customer_id, supplier_id)
      LEFT JOIN snames sn USING (customer_id, supplier_id)
      LEFT JOIN cattr a USING (customer_id)
      CROSS JOIN gcb"""),
]


def pair_prefix(extra: list[tuple[str, str]] = (), fixtures: tuple[str, ...] = ()) -> str:
    return ledger_prefix(PAIR_CTES + list(extra), fixtures)


# ---------------------------------------------------------------------------
# customer-level normalisation, weights and pair scores
# ---------------------------------------------------------------------------
from ..params import (NEGATIVE_METRICS, PAIR_FIXED_WEIGHTS, PAIR_METRICS, POSITIVE_METRICS,  # noqa: E402
                      ZEROED_METRICS)

C001 = "CAST(0.01 AS DOUBLE)"


def zexpr(m: str, w: str) -> str:
    return (f"coalesce(CASE WHEN max({m}) OVER {w} <> min({m}) OVER {w} THEN ({m} - avg({m}) OVER {w}) "
            f"/ nullif(stddev_samp({m}) OVER {w}, 0) END, 0)")


def norm_ctes(src: str, keys: str, metrics=PAIR_METRICS, tag: str = "c") -> list[tuple[str, str]]:
    w = f"(PARTITION BY {keys})" if keys else "()"
    z = ", ".join(f"{zexpr(m, w)} AS z_{m}" for m in metrics)
    zm = ", ".join(f"CASE WHEN {m} = 0 THEN 0 ELSE z_{m} END AS zm_{m}" for m in metrics)
    n = ", ".join(
        f"CASE WHEN {m} = 0 THEN 0 ELSE ((zm_{m} - min(zm_{m}) OVER {w}) + {C001}) / "
        f"((max(zm_{m}) OVER {w} - min(zm_{m}) OVER {w}) + {C001}) END AS n_{m}" for m in metrics)
    return [(f"{tag}_z", f"SELECT *, {z} FROM {src}"),
            (f"{tag}_zm", f"SELECT *, {zm} FROM {tag}_z"),
            (f"{tag}_n", f"SELECT *, {n} FROM {tag}_zm")]


def rowwise_sql(group) -> dict[str, str]:
    mean = "((" + " + ".join(group) + f") / {len(group)})"
    var = "((" + " + ".join(f"({m} - {mean}) * ({m} - {mean})" for m in group) + f") / {len(group)})"
    std = f"sqrt({var})"
    return {m: f"({m} - {mean}) / nullif({std}, 0)" for m in group}


def pearson_sql(x: str, y: str) -> str:
    xs = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {x} END"
    ys = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {y} END"
    return (f"CASE WHEN NOT (max({xs}) = min({xs}) OR max({ys}) = min({ys})) "
            f"AND stddev_samp({xs}) * stddev_samp({ys}) <> 0 "
            f"THEN covar_samp({xs}, {ys}) / (stddev_samp({xs}) * stddev_samp({ys})) END")


def forced_sql(m: str, corr: str, positive=POSITIVE_METRICS, negative=NEGATIVE_METRICS, zeroed=ZEROED_METRICS):
    if m in zeroed:
        return "CAST(0 AS DOUBLE)"
    if m in positive:
        return f"abs({corr})"
    if m in negative:
        return f"-abs({corr})"
    return corr


def weight_select(fixed: str, metrics=PAIR_METRICS, fixed_weights=PAIR_FIXED_WEIGHTS, zeroed=ZEROED_METRICS,
                  target: str = "risk_balance") -> str:
    out = []
    for m, fw in zip(metrics, fixed_weights):
        corr = f"coalesce({pearson_sql(m, target)}, 0)"
        out.append(f"CASE WHEN {fixed} THEN CAST({float(fw)!r} AS DOUBLE) ELSE {forced_sql(m, corr, zeroed=zeroed)} "
                   f"END AS w_{m}")
    return ", ".join(out)


def wsum_sql(metrics=PAIR_METRICS, n: str = "n_", w: str = "w_") -> str:
    return " + ".join(f"coalesce({n}{m} * {w}{m}, 0)" for m in metrics)


def level_sql(s: str) -> str:
    return (f"CAST(CASE WHEN {s} > -1 AND {s} <= 250 THEN 1 WHEN {s} > 250 AND {s} <= 400 THEN 2 "
            f"WHEN {s} > 400 AND {s} <= 800 THEN 3 END AS INT)")


def clamp_sql(s: str, lo=0, hi=800) -> str:
    return f"CASE WHEN {s} < {lo} THEN {lo} WHEN {s} > {hi} THEN {hi} ELSE {s} END"


_single = []
for _grp in (POSITIVE_METRICS, NEGATIVE_METRICS):
    for _m, _z in rowwise_sql(_grp).items():
        _single.append((_m, f"CASE WHEN n_pairs = 1 THEN abs(CASE WHEN {_m} = 0 THEN 0 ELSE {_z} END) ELSE n_{_m} END"))

SCORE_CTES = norm_ctes("(SELECT *, count(*) OVER (PARTITION BY customer_id) AS n_pairs FROM pair_metrics) pm",
                       "customer_id") + [
    ("c_norm", "SELECT * REPLACE (" + ", ".join(f"{e} AS n_{m}" for m, e in _single) + ") FROM c_n"),
    ("c_w", "SELECT customer_id, " + weight_select("(max(risk_balance) <= 0 OR count(*) = 1)")
     + " FROM pair_metrics GROUP BY customer_id"),
    ("c_corr", "SELECT customer_id, " + ", ".join(f"coalesce({pearson_sql(m, 'risk_balance')}, 0) AS corr_{m}"
                                                  for m in PAIR_METRICS) + " FROM pair_metrics GROUP BY customer_id"),
    ("c_scored0", f"""SELECT n.*, {', '.join('w.w_' + m for m in PAIR_METRICS)},
        CASE WHEN customer_type_id = 4 THEN (({wsum_sql()}) + 57) * 2.7708333333333335
             ELSE (({wsum_sql()}) + 3) * 133.3333 END AS score_raw
        FROM c_norm n JOIN c_w w USING (customer_id)"""),
    ("pair_scores", f"SELECT *, {clamp_sql('round_even(score_raw, 0)')} AS score FROM c_scored0"),
]


def score_prefix(extra=(), fixtures=()) -> str:
    return pair_prefix(SCORE_CTES + list(extra), fixtures)
