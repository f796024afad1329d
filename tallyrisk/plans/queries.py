"""Registry of queries: name -> callable(spark, sf_dir) -> DataFrame."""
from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, metrics
from ..params import DEFAULT
from ..sources.tables import Tables

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def ledger(t: Tables) -> DataFrame:
    """Cleaned ledger; materialised because metrics, predictions and history each read it."""
    return t.stage("ledger", lambda: clean.unified_ledger(*(t.within(n, DEFAULT.window_start, DEFAULT.processing_date) for n in ("invoice_payments", "chargebacks")),
                                                          DEFAULT))


def pairs(t: Tables) -> DataFrame:
    """Pair metrics; materialised because every later stage reads them."""
    return t.stage("pairs", lambda: metrics.pair_metrics(ledger(t), DEFAULT))


@query("pair_metrics")
def q_pair_metrics(spark, sf_dir):
    return pairs(Tables.for_run(spark, sf_dir))


# ---------------------------------------------------------------------------
# customer-level normalisation, weights and pair scores
# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from ..operators import normalize, score, weights  # noqa: E402
from ..params import PAIR_METRICS  # noqa: E402


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round computed doubles to 6 places (statistics differ between engines in the last bits)."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


@query("zscore_customer")
def q_zscore_customer(spark, sf_dir):
    z = normalize.zscore(pairs(Tables.for_run(spark, sf_dir)), PAIR_METRICS, ["customer_id"])
    zc = ["z_" + m for m in PAIR_METRICS]
    return r6(z.select("customer_id", "supplier_id", *zc), *zc)


@query("masked_minmax_customer")
def q_masked_minmax_customer(spark, sf_dir):
    n = normalize.masked_minmax(pairs(Tables.for_run(spark, sf_dir)), PAIR_METRICS, ["customer_id"])
    nc = ["n_" + m for m in PAIR_METRICS]
    return r6(n.select("customer_id", "supplier_id", *nc), *nc)


@query("single_supplier_norm")
def q_single_supplier_norm(spark, sf_dir):
    n = score.customer_normalised(pairs(Tables.for_run(spark, sf_dir))).filter(F.col("n_pairs") == 1)
    nc = ["n_" + m for m in PAIR_METRICS]
    return r6(n.select("customer_id", "supplier_id", *nc), *nc)


@query("customer_corr_weights")
def q_customer_corr_weights(spark, sf_dir):
    cc = ["corr_" + m for m in PAIR_METRICS]
    return r6(weights.customer_corr_weights(pairs(Tables.for_run(spark, sf_dir))), *cc)


@query("customer_weights")
def q_customer_weights(spark, sf_dir):
    wc = ["w_" + m for m in PAIR_METRICS]
    return r6(customer_weights(Tables.for_run(spark, sf_dir)), *wc)


#: what later steps read of a scored pair; its metrics are those of ``pairs``
SCORED = ("customer_id", "supplier_id", "supplier_name", "ndg_id", "total_invoice", "open_ar", "total_ar", "outstanding_balance", "score_raw", "score",
          "level")


def scored_pairs(t: Tables) -> DataFrame:
    return t.stage("scored_pairs", lambda: score.pair_scores(pairs(t)).select(*SCORED))


def customer_weights(t: Tables) -> DataFrame:
    return t.stage("customer_weights", lambda: weights.customer_weights(pairs(t)))


@query("pair_score")
def q_pair_score(spark, sf_dir):
    s = scored_pairs(Tables.for_run(spark, sf_dir))
    return s.select("customer_id", "supplier_id", F.round("score_raw", 4).alias("score_raw"), "score", "level")


@query("level_buckets")
def q_level_buckets(spark, sf_dir):
    return score.level_buckets(scored_pairs(Tables.for_run(spark, sf_dir)))


# ---------------------------------------------------------------------------
# predictors
# ---------------------------------------------------------------------------
from ..functions.scalar import from_units  # noqa: E402
from ..operators import predict  # noqa: E402


def _predict_invoices(spark, sf_dir, h):
    t = Tables.for_run(spark, sf_dir)
    out = predict.predict_invoices(ledger(t), pairs(t), h)
    return out.withColumn("predicted", from_units("predicted_u")).drop("predicted_u")


def _predict_pairs(spark, sf_dir, h):
    t = Tables.for_run(spark, sf_dir)
    return predictions(t).select(*PAIR_KEYS, f"predict_ar_{h}d")


REGISTRY["predict_10d"] = lambda spark, sf_dir: _predict_invoices(spark, sf_dir, 10)
REGISTRY["predict_30d"] = lambda spark, sf_dir: _predict_invoices(spark, sf_dir, 30)
REGISTRY["predict_pair_10d"] = lambda spark, sf_dir: _predict_pairs(spark, sf_dir, 10)
REGISTRY["predict_pair_30d"] = lambda spark, sf_dir: _predict_pairs(spark, sf_dir, 30)


# ---------------------------------------------------------------------------
# supplier exposure, weights and scores
# ---------------------------------------------------------------------------
from ..operators import supplier as sup  # noqa: E402
from ..params import SUPPLIER_METRICS, SUPPLIER_TEST_WEIGHTS  # noqa: E402

PAIR_KEYS = ["customer_id", "supplier_id"]


def open_predictions(t: Tables) -> DataFrame:
    """10- and 30-day predictions of the pairs with open invoices due, from one pass over those (materialised)."""
    return t.stage("open_predictions", lambda: predict.predict_open_pairs(ledger(t), pairs(t), (10, 30)))


def predictions(t: Tables) -> DataFrame:
    """10- and 30-day predictions of every pair."""
    return predict.with_predictions(pairs(t).select(*PAIR_KEYS), open_predictions(t))


def pair_frame(t: Tables) -> DataFrame:
    """Scored pairs with their 10- and 30-day predictions (materialised)."""
    def build():
        sc = scored_pairs(t).select(*PAIR_KEYS, "supplier_name", "total_invoice", "open_ar", "total_ar",
                                    "outstanding_balance", "score")
        return predict.with_predictions(sc, open_predictions(t))
    return t.stage("pair_frame", build)


def test_weights(spark) -> DataFrame:
    """Injected supplier weights (positive .4, negative -.3, free .2) for oracle-checked scores."""
    return sup.weights_frame(spark, SUPPLIER_TEST_WEIGHTS)


def _dim(t: Tables) -> DataFrame:
    return t.stage("supplier_dim", lambda: sup.supplier_dimension(t))


def _supplier_pairs(t: Tables) -> DataFrame:
    return sup.supplier_pairs(pair_frame(t), _dim(t))


def _supplier_totals(t: Tables) -> DataFrame:
    return sup.supplier_totals(sup.supplier_rollup(pair_frame(t)), _dim(t))


@query("payables_by_supplier")
def q_payables_by_supplier(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    df = sup.payables_by_supplier(t.open_payable, t.unapplied_balance)
    return df.select("supplier_id", from_units("open_payable_u").alias("open_payable"),
                     from_units("unapplied_u").alias("unapplied_amount"))


@query("other_payables_by_supplier")
def q_other_payables_by_supplier(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return sup.other_payables_by_supplier(t.other_open_payables).select(
        "supplier_id", from_units("other_open_payables_u").alias("other_open_payables"))


@query("credit_memo_by_supplier")
def q_credit_memo_by_supplier(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return sup.credit_memo_by_supplier(t.credit_memo, t.crm_classes).select(
        "supplier_id", from_units("open_credit_memo_u").alias("open_credit_memo"))


SP_COLS = ["customer_id", "supplier_id", "total_invoice", "total_ar", "unapplied_amount", "open_payable",
           "open_credit_memo", "other_open_payables", "cash_balance", "wallet", "risk_balance", "customer_score"]


@query("supplier_exposure_pair")
def q_supplier_exposure_pair(spark, sf_dir):
    return _supplier_pairs(Tables.for_run(spark, sf_dir)).select(*SP_COLS)


@query("supplier_rollup")
def q_supplier_rollup(spark, sf_dir):
    return r6(sup.supplier_rollup(pair_frame(Tables.for_run(spark, sf_dir))), "customer_score")


@query("supplier_exposure_total")
def q_supplier_exposure_total(spark, sf_dir):
    return r6(_supplier_totals(Tables.for_run(spark, sf_dir)).select(*SP_COLS[1:], "open_ar"), "customer_score")


def fitted_weights(t: Tables) -> dict[str, float]:
    """First principal component, to 6 places (engines differ in the last bits of an eigenvector)."""
    return {m: round(float(w), 6) + 0.0 for m, w in sup.pca_weights(_supplier_totals(t)).items()}


@query("supplier_pca_weights")
def q_supplier_pca_weights(spark, sf_dir):
    w = fitted_weights(Tables.for_run(spark, sf_dir))
    return spark.createDataFrame([(m, w[m]) for m in SUPPLIER_METRICS], ["metric", "weight"])


@query("supplier_weights")
def q_supplier_weights(spark, sf_dir):
    return sup.supplier_weights(_supplier_totals(Tables.for_run(spark, sf_dir)), test_weights(spark))


@query("masked_minmax_supplier")
def q_masked_minmax_supplier(spark, sf_dir):
    n = sup.supplier_normalised(_supplier_pairs(Tables.for_run(spark, sf_dir)))
    nc = ["n_" + m for m in SUPPLIER_METRICS]
    return r6(n.select("customer_id", "supplier_id", *nc), *nc)


def _supplier_pair_scores(spark, t):
    helpers = ("n_customers", *(x + m for x in ("n_", "w_") for m in SUPPLIER_METRICS))
    return t.stage("supplier_pair_scores", lambda: sup.supplier_pair_scores(_supplier_pairs(t), test_weights(spark)).drop(*helpers))


@query("supplier_pair_score")
def q_supplier_pair_score(spark, sf_dir):
    s = _supplier_pair_scores(spark, Tables.for_run(spark, sf_dir))
    return s.select("customer_id", "supplier_id", F.round("score_raw", 4).alias("score_raw"), "score", "level")


@query("supplier_pair_score_fitted")
def q_supplier_pair_score_fitted(spark, sf_dir):
    """Supplier pair scores with the weights that the run fits."""
    t = Tables.for_run(spark, sf_dir)
    s = sup.supplier_pair_scores(_supplier_pairs(t), sup.weights_frame(spark, fitted_weights(t)))
    return s.select("customer_id", "supplier_id", F.round("score_raw", 4).alias("score_raw"), "score", "level")


@query("risk_factors_fitted")
def q_risk_factors_fitted(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return sup.risk_factors(_supplier_totals(t), sup.weights_frame(spark, fitted_weights(t)))


@query("risk_factors")
def q_risk_factors(spark, sf_dir):
    return sup.risk_factors(_supplier_totals(Tables.for_run(spark, sf_dir)), test_weights(spark))


@query("modal_level_supplier")
def q_modal_level_supplier(spark, sf_dir):
    return sup.modal_level(_supplier_pair_scores(spark, Tables.for_run(spark, sf_dir)), "supplier_id")


def _agg_supplier(spark, t):
    scored = _supplier_pair_scores(spark, t)
    agg = t.stage("agg_supplier", lambda: sup.agg_supplier_metrics(scored.drop("score", "level", "score_raw")))
    return agg, t.stage("modal_supplier", lambda: sup.modal_level(scored, "supplier_id"))


@query("agg_supplier_metrics")
def q_agg_supplier_metrics(spark, sf_dir):
    agg, _ = _agg_supplier(spark, Tables.for_run(spark, sf_dir))
    return r6(agg, "customer_score")


@query("masked_minmax_bucket")
def q_masked_minmax_bucket(spark, sf_dir):
    agg, modal = _agg_supplier(spark, Tables.for_run(spark, sf_dir))
    n = normalize.masked_minmax(agg.join(modal, "supplier_id", "left"), SUPPLIER_METRICS, ["modal_level"])
    nc = ["n_" + m for m in SUPPLIER_METRICS]
    return r6(n.select("supplier_id", "modal_level", *nc), *nc)


@query("agg_supplier_score")
def q_agg_supplier_score(spark, sf_dir):
    agg, modal = _agg_supplier(spark, Tables.for_run(spark, sf_dir))
    s = sup.agg_supplier_score(agg, modal, test_weights(spark))
    return s.select("supplier_id", "modal_level", F.round("score_raw", 4).alias("score_raw"), "score", "level")


@query("pair_detail")
def q_pair_detail(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    pf = pair_frame(t)
    det = sup.with_exposure(pf, _dim(t), open_ar="total_ar")
    det = det.withColumnRenamed("risk_balance_s", "supplier_risk_balance")
    cs = sup.contract_status_by_supplier(t.contract_status)
    return det.join(cs, "supplier_id", "left").drop("supplier_name")


# ---------------------------------------------------------------------------
# customer and group roll-ups
# ---------------------------------------------------------------------------
from ..operators import aggregate as agg_ops  # noqa: E402
from ..params import CUSTOMER_AGG_METRICS  # noqa: E402

CUST_ATTRS = ("ndg_id", "ndg_name", "customer_name", "customer_type_id", "customer_type")


def cust_pairs(t: Tables) -> DataFrame:
    """Scored pairs with every metric and both predictions."""
    own = scored_pairs(t).select(*PAIR_KEYS, "score_raw", "score", "level")
    return predict.with_predictions(pairs(t).join(own, PAIR_KEYS), open_predictions(t))


def rollup_rows(t: Tables) -> DataFrame:
    """The pairs' metrics and predictions for the roll-ups, which only add them up."""
    return predict.stacked_predictions(pairs(t), open_predictions(t))


def cust_agg(t: Tables) -> DataFrame:
    return t.stage("cust_agg", lambda: agg_ops.aggregate_metrics(rollup_rows(t), "customer_id", CUST_ATTRS))


def cust_scores(t: Tables) -> DataFrame:
    """Customer scores with the normalised metrics that overrides score anew."""
    return t.stage("cust_scores", lambda: agg_ops.agg_customer_score(cust_agg(t), customer_weights(t)).select(
        "customer_id", "customer_type_id", *["n_" + m for m in CUSTOMER_AGG_METRICS], "score", "level"))


@query("agg_customer_metrics")
def q_agg_customer_metrics(spark, sf_dir):
    df = cust_agg(Tables.for_run(spark, sf_dir))
    return r6(df, *[c for c, tp in df.dtypes if tp == "double"])


@query("ratio_rescale")
def q_ratio_rescale(spark, sf_dir):
    return r6(cust_agg(Tables.for_run(spark, sf_dir)).select("customer_id", *agg_ops.RATIOS), *agg_ops.RATIOS)


@query("modal_level_customer")
def q_modal_level_customer(spark, sf_dir):
    return sup.modal_level(scored_pairs(Tables.for_run(spark, sf_dir)), "customer_id")


@query("customer_minmax")
def q_customer_minmax(spark, sf_dir):
    df = cust_agg(Tables.for_run(spark, sf_dir)).withColumn("payment_cycle", F.col("dbt"))
    n = agg_ops.global_minmax(df, CUSTOMER_AGG_METRICS, prefix="n_")
    nc = ["n_" + m for m in CUSTOMER_AGG_METRICS]
    return r6(n.select("customer_id", *nc), *nc)


@query("agg_customer_score")
def q_agg_customer_score(spark, sf_dir):
    return cust_scores(Tables.for_run(spark, sf_dir)).select("customer_id", "customer_type_id", "score", "level")


@query("international_adjust")
def q_international_adjust(spark, sf_dir):
    return agg_ops.international_adjust(cust_scores(Tables.for_run(spark, sf_dir))).select(
        "customer_id", "customer_type_id", "score", "level")


def ndg_agg(t: Tables) -> DataFrame:
    return t.stage("ndg_agg", lambda: agg_ops.aggregate_metrics(rollup_rows(t), "ndg_id"))


def ndg_modal(t: Tables) -> DataFrame:
    return sup.modal_level(scored_pairs(t), "ndg_id")


def ndg_raw(t: Tables) -> DataFrame:
    return t.stage("ndg_raw", lambda: agg_ops.ndg_score_raw(ndg_agg(t), ndg_modal(t)))


def cust_map(t: Tables) -> DataFrame:
    return agg_ops.customer_group_map(cust_agg(t))


def final_cust_scores(t: Tables) -> DataFrame:
    return t.stage("final_cust_scores", lambda: agg_ops.international_adjust(cust_scores(t)).select(
        "customer_id", "customer_type_id", "score", "level"))


@query("agg_ndg_metrics")
def q_agg_ndg_metrics(spark, sf_dir):
    df = ndg_agg(Tables.for_run(spark, sf_dir))
    return r6(df, *[c for c, tp in df.dtypes if tp == "double"])


@query("modal_level_ndg")
def q_modal_level_ndg(spark, sf_dir):
    return ndg_modal(Tables.for_run(spark, sf_dir))


@query("ndg_corr_weights")
def q_ndg_corr_weights(spark, sf_dir):
    from ..params import GROUP_FIXED_WEIGHTS
    t = Tables.for_run(spark, sf_dir)
    df = ndg_agg(t).join(ndg_modal(t), "ndg_id", "left")
    fixed = (F.max(F.abs(F.col("risk_balance"))) == 0) | (F.count(F.lit(1)) == 1)
    wexpr = weights.weight_exprs(fixed, PAIR_METRICS, GROUP_FIXED_WEIGHTS, zeroed=())
    w = df.groupBy("modal_level").agg(*[e.alias(n) for n, e in wexpr.items()])
    return r6(w, *wexpr.keys())


@query("ndg_score_raw")
def q_ndg_score_raw(spark, sf_dir):
    s = ndg_raw(Tables.for_run(spark, sf_dir))
    return s.select("ndg_id", "modal_level", F.round("score_raw", 4).alias("score_raw"), "score", "level")


def ndg_with_members(t: Tables) -> DataFrame:
    return agg_ops.ndg_single_member(ndg_raw(t), cust_map(t), final_cust_scores(t))


@query("ndg_single_member")
def q_ndg_single_member(spark, sf_dir):
    return ndg_with_members(Tables.for_run(spark, sf_dir)).select("ndg_id", "score")


@query("ndg_score_spread")
def q_ndg_score_spread(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    sp = agg_ops.ndg_score_spread(ndg_with_members(t), cust_map(t), final_cust_scores(t))
    return r6(sp, "cust_mean_score", "old_ndg_score")


@query("ndg_score")
def q_ndg_score(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    members = ndg_with_members(t)
    sp = agg_ops.ndg_score_spread(members, cust_map(t), final_cust_scores(t))
    return agg_ops.ndg_final(members, sp).select("ndg_id", "score", "level")


# ---------------------------------------------------------------------------
# scans, cleaning and metric subsets
# ---------------------------------------------------------------------------
from ..sources import tables as src_tables  # noqa: E402

INVOICE_VIEW = ["invoice_num", "customer_id", "supplier_id", "ispaid", "invoice_date", "duedate", "txn_date",
                "invoice_amount", "txn_amount", "txn_type", "memo"]


@query("scan_dimensions")
def q_scan_dimensions(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    cust = src_tables.coerce_ids(t.crm_customers, ["customer_id", "ndg_id"])
    ndg = src_tables.coerce_ids(t.crm_ndg, ["id"]).select(F.col("id").alias("ndg_id"), F.col("name").alias("ndg"))
    return cust.join(ndg, "ndg_id", "left").select("customer_id", "customer", "customer_type_id", "ndg_id", "ndg")


@query("scan_window")
def q_scan_window(spark, sf_dir):
    return clean.scan_window(Tables.for_run(spark, sf_dir).invoice_payments, "invoice_date").select(*INVOICE_VIEW)


@query("clean_early_advance")
def q_clean_early_advance(spark, sf_dir):
    inv = clean.scan_window(Tables.for_run(spark, sf_dir).invoice_payments, "invoice_date")
    return clean.clean_early_advance(inv).select(*INVOICE_VIEW)


@query("drop_full_credit_memo")
def q_drop_full_credit_memo(spark, sf_dir):
    return clean.clean_invoices(Tables.for_run(spark, sf_dir).invoice_payments).select(*INVOICE_VIEW)


LEDGER_VIEW = ["src", "customer_id", "supplier_id", "invoice_num", "ispaid", "invoice_date", "duedate", "txn_date",
               "invoice_amount", "txn_amount", "total_amount", "open_balance", "paid_amount", "bill_date",
               "cb_duedate", "paid_date", "ndg_id", "ndg_name"]


@query("clean_fill")
def q_clean_fill(spark, sf_dir):
    return ledger(Tables.for_run(spark, sf_dir)).filter(F.col("src") == "inv").select(*LEDGER_VIEW)


@query("unified_ledger")
def q_unified_ledger(spark, sf_dir):
    return ledger(Tables.for_run(spark, sf_dir)).select(*LEDGER_VIEW)


@query("customer_attributes")
def q_customer_attributes(spark, sf_dir):
    return clean.customer_attributes(ledger(Tables.for_run(spark, sf_dir)))


@query("historical_pairs")
def q_historical_pairs(spark, sf_dir):
    return clean.historical_pairs(ledger(Tables.for_run(spark, sf_dir)))


SUBSETS = {
    "pair_ar_balances": ["invoice_freq", "total_invoice", "total_ar", "open_ar", "paid_invoice", "unpaid_invoice",
                         "outstanding_balance"],
    "pair_payment_behaviour": ["early_payment_perc", "early_payment_amount", "early_payment_days",
                               "payment_timeliness_ratio", "late_payment_ratio_lt10", "late_payment_ratio_gt10",
                               "delinquent_payment_lt10", "delinquent_overdueday_lt10", "delinquent_payment_gt10",
                               "delinquent_overdueday_gt10", "payment1_percent", "payment2_percent",
                               "payment2_percent_wo_cb"],
    "pair_payment_cycle_dbt": ["payment_cycle", "dbt", "aging_balance", "payment_predictor"],
    "pair_counts": ["invoice_freq", "suppliers_freq", "num_supplier_w_open_invoice"],
    "pair_chargebacks": ["chargeback_freq", "chargeback_vol_amt", "chargeback_vol_paid", "chargeback_vol_unpaid",
                         "overdue_chargebacks", "early_chargeback", "timeliness_of_chargeback",
                         "open_chargeback_freq", "open_chargeback_vol_amt", "w_o_open_cb", "risk_balance"],
}

for _name, _cols in SUBSETS.items():
    REGISTRY[_name] = (lambda cols: lambda spark, sf_dir: pairs(Tables.for_run(spark, sf_dir)).select(*PAIR_KEYS, *cols))(_cols)


@query("global_overdue_cb_suppliers")
def q_global_overdue_cb_suppliers(spark, sf_dir):
    return metrics.overdue_cb_suppliers(metrics.pair_aggregate(ledger(Tables.for_run(spark, sf_dir))))


# ---------------------------------------------------------------------------
# overrides and reasons
# ---------------------------------------------------------------------------
from ..operators import override as ovr  # noqa: E402
from ..params import DEFAULT as P  # noqa: E402


def supplier_reasons(t: Tables) -> DataFrame:
    """Stored supplier reasons plus default rows for suppliers that have none."""
    matrix = ovr.reason_matrix(t.crm_classes, "supplier_id", t.override_reasons)
    existing = t.supplier_reason
    return existing.unionByName(ovr.reason_missing_rows(matrix, existing, "supplier_id"))


def customer_reasons(t: Tables) -> DataFrame:
    matrix = ovr.reason_matrix(t.crm_customers, "customer_id", t.override_reasons)
    existing = t.customer_reason
    return existing.unionByName(ovr.reason_missing_rows(matrix, existing, "customer_id"))


def _agg_supplier_scores(spark, t):
    def build():
        agg, modal = _agg_supplier(spark, t)
        return sup.agg_supplier_score(agg, modal, test_weights(spark))
    return t.stage("agg_supplier_scores", build)


def supplier_overrides(spark, t):
    def build():
        scores = _agg_supplier_scores(spark, t)
        latest = ovr.latest_override(t.supplier_update_level, "supplier_id")
        w = sup.supplier_weights(scores, test_weights(spark))
        return ovr.apply_overrides(scores, "supplier_id", latest, w, scores, SUPPLIER_METRICS, supplier_reasons(t),
                                   P.c("c1"))
    return t.stage("supplier_overrides", build)


@query("latest_override")
def q_latest_override(spark, sf_dir):
    return ovr.latest_override(Tables.for_run(spark, sf_dir).supplier_update_level, "supplier_id")


@query("override_supplier")
def q_override_supplier(spark, sf_dir):
    out = supplier_overrides(spark, Tables.for_run(spark, sf_dir))
    return r6(out.drop("reason"), "external_factor")


def customer_overrides(t: Tables) -> DataFrame:
    def build():
        pre = cust_scores(t)
        latest = ovr.latest_override(t.customer_update_level, "customer_id")
        return ovr.apply_overrides(final_cust_scores(t), "customer_id", latest, customer_weights(t), pre, CUSTOMER_AGG_METRICS,
                                   customer_reasons(t), P.c("c2"), std_from=pre, weighted=PAIR_METRICS)
    return t.stage("customer_overrides", build)


@query("override_customer")
def q_override_customer(spark, sf_dir):
    out = customer_overrides(Tables.for_run(spark, sf_dir))
    return r6(out.drop("reason"), "external_factor")


@query("reason_matrix")
def q_reason_matrix(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ovr.reason_matrix(t.crm_customers, "customer_id", t.override_reasons)


@query("reason_missing_rows")
def q_reason_missing_rows(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ovr.reason_missing_rows(ovr.reason_matrix(t.crm_customers, "customer_id", t.override_reasons), t.customer_reason,
                                   "customer_id")


@query("reason_weight_lookup")
def q_reason_weight_lookup(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    latest = ovr.latest_override(t.supplier_update_level, "supplier_id")
    ov = latest.join(_agg_supplier_scores(spark, t).select("supplier_id"), "supplier_id", "left_semi")
    return ovr.reason_weight_lookup(ov, supplier_reasons(t), "supplier_id")


@query("reason_weight_update")
def q_reason_weight_update(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    out = ovr.reason_weight_update(supplier_reasons(t), supplier_overrides(spark, t), "supplier_id")
    return r6(out, "weight")


# ---------------------------------------------------------------------------
# every customer x supplier combination (kept virtual)
# ---------------------------------------------------------------------------
from ..operators import cross  # noqa: E402


def cross_inputs(spark, t: Tables) -> cross.CrossInputs:
    return cross.CrossInputs(t.crm_customers, t.crm_classes, customer_overrides(t),
                             supplier_overrides(spark, t), scored_pairs(t))


def _entity_finals(spark, t):
    ci = cross_inputs(spark, t)
    cf = t.stage("cross_cust_final", lambda: cross.entity_final(ci.name_means("customer"), "customer_id", "customer"))
    sf = t.stage("cross_sup_final", lambda: cross.entity_final(ci.name_means("supplier"), "supplier_id", "supplier"))
    return ci, cf, sf


@query("global_score_stats")
def q_global_score_stats(spark, sf_dir):
    st = cross_inputs(spark, Tables.for_run(spark, sf_dir)).stats
    return r6(st, *st.columns)


@query("centroids")
def q_centroids(spark, sf_dir):
    return cross_inputs(spark, Tables.for_run(spark, sf_dir)).cents


@query("impute_pairs")
def q_impute_pairs(spark, sf_dir):
    imp = cross_inputs(spark, Tables.for_run(spark, sf_dir)).imputation("supplier")
    return imp.select("supplier_id", "s_val", "o_val", "n", "i_comb", "i_cust", "i_sup")


@query("nearest_centroid")
def q_nearest_centroid(spark, sf_dir):
    imp = cross_inputs(spark, Tables.for_run(spark, sf_dir)).imputation("customer")
    return r6(imp.select("customer_id", "s_val", "o_val", "n", "distance1", "distance2", "distance3", "cluster"),
              "distance1", "distance2", "distance3")


@query("impute_values")
def q_impute_values(spark, sf_dir):
    """One row for each (customer value, supplier value): the score of every pair without history."""
    return cross_inputs(spark, Tables.for_run(spark, sf_dir)).value_table().select(
        "c_val", "s_val", "n_c", "n_s", "cluster", "i_comb", "i_cust", "i_sup", "combined_score", "combined_level")


@query("pair_lookup")
def q_pair_lookup(spark, sf_dir):
    """Scores of requested pairs: each order asks for its customer with a supplier by number."""
    t = Tables.for_run(spark, sf_dir)
    requests = t.orders.select(F.col("o_custkey").alias("customer_id"), (F.col("o_orderkey") % 50 + 1).alias("supplier_id")).distinct()
    return cross_inputs(spark, t).lookup_pairs(requests)


@query("cross_name_means")
def q_cross_name_means(spark, sf_dir):
    ci = cross_inputs(spark, Tables.for_run(spark, sf_dir))
    s = ci.name_means("supplier").select(F.lit("supplier").alias("entity"), F.col("supplier_id").alias("id"),
                                          "n_history", "mean_score")
    c = ci.name_means("customer").select(F.lit("customer").alias("entity"), F.col("customer_id").alias("id"),
                                          "n_history", "mean_score")
    return r6(s.unionByName(c), "mean_score")


@query("cross_finish")
def q_cross_finish(spark, sf_dir):
    ci, cf, sf = _entity_finals(spark, Tables.for_run(spark, sf_dir))
    return r6(ci.finished_pairs(cf, sf), "customer_score", "supplier_score")


@query("cross_product_scores")
def q_cross_product_scores(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    ci = cross_inputs(spark, t)
    n_sup = ci.sup.count()
    nh = ci.hist_pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_history"))
    return (ci.cust.join(nh, "customer_id", "left")
            .select("customer_id", "score", F.col("val").alias("customer_value"),
                    F.coalesce(F.col("n_history"), F.lit(0)).alias("n_history"),
                    (F.lit(n_sup) - F.coalesce(F.col("n_history"), F.lit(0))).alias("n_imputed")))


@query("cross_union_all")
def q_cross_union_all(spark, sf_dir):
    _, cf, sf = _entity_finals(spark, Tables.for_run(spark, sf_dir))
    c = cf.select(F.lit("customer").alias("entity"), F.col("customer_id").alias("id"),
                  F.col("customer_score").alias("score"), F.col("customer_level").alias("level"))
    s = sf.select(F.lit("supplier").alias("entity"), F.col("supplier_id").alias("id"),
                  F.col("supplier_score").alias("score"), F.col("supplier_level").alias("level"))
    return r6(c.unionByName(s), "score")


def _customer_updated(spark, t):
    _, cf, _ = _entity_finals(spark, t)
    return cross.update_from_join(cf, customer_overrides(t), "customer_id", "customer")


@query("update_from_join")
def q_update_from_join(spark, sf_dir):
    return r6(_customer_updated(spark, Tables.for_run(spark, sf_dir)), "customer_score")


@query("override_nonhistorical")
def q_override_nonhistorical(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    latest = ovr.latest_override(t.customer_update_level, "customer_id")
    out = cross.override_nonhistorical(_customer_updated(spark, t), latest, customer_overrides(t), "customer_id",
                                       "customer")
    return r6(out, "customer_score")


# ---------------------------------------------------------------------------
# raw extraction queries
# ---------------------------------------------------------------------------
from ..operators import extract as ex  # noqa: E402

W_START, W_END = P.window_start, P.processing_date


def _status(t):
    return ex.supplier_status(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)


def _invoice(t, start, end):
    return ex.extract_invoice(t.within("raw_invoices", start, end), t.raw_payments, t.raw_suppliers, t.raw_customers, t.raw_ndg,
                              t.raw_customer_types, start, end)


REGISTRY["extract_window_daily"] = lambda spark, sf_dir: _invoice(Tables.for_run(spark, sf_dir), W_END, W_END)
REGISTRY["extract_window_2yr"] = lambda spark, sf_dir: _invoice(Tables.for_run(spark, sf_dir), W_START, W_END)
REGISTRY["extract_invoice"] = lambda spark, sf_dir: _invoice(Tables.for_run(spark, sf_dir), P.fixed_start, W_END)


@query("next_payment_date")
def q_next_payment_date(spark, sf_dir):
    return ex.next_payment_date(Tables.for_run(spark, sf_dir).raw_payments).select(
        "txn_id", "txn_date", "memo", "amount", "corrected_txn_date")


@query("extract_chargebacks")
def q_extract_chargebacks(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    parties = ex.vendor_customers(t.raw_vendor_companies, t.raw_companies, t.raw_company_customers, t.raw_customers,
                                  t.raw_ndg, t.raw_customer_types)
    return ex.extract_chargebacks(t.raw_bills, t.raw_bill_lines, t.raw_accounts, t.raw_bill_payments, parties,
                                  t.raw_suppliers, t.raw_entities, t.raw_bill_metadata, W_START, W_END)


@query("bill_account_summary")
def q_bill_account_summary(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.bill_account_summary(t.raw_bill_lines, t.raw_accounts)


@query("extract_other_open_payables")
def q_extract_other_open_payables(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_other_open_payables(t.raw_bills, t.raw_bill_lines, t.raw_accounts, t.raw_bill_payments,
                                          ex.vendor_companies(t.raw_vendor_companies, t.raw_companies),
                                          t.raw_suppliers, _status(t), W_START, W_END)


@query("extract_open_payable")
def q_extract_open_payable(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return r6(ex.extract_open_payable(t.raw_supplier_invoice, _status(t), W_START, W_END), "open_payable")


@query("extract_unapplied_balance")
def q_extract_unapplied_balance(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return r6(ex.extract_unapplied_balance(t.raw_supplier_invoice, _status(t), W_START, W_END), "unapplied_amount")


@query("extract_credit_memo")
def q_extract_credit_memo(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_credit_memo(t.raw_credit_memos, _status(t), W_START, W_END)


@query("extract_cash_balance")
def q_extract_cash_balance(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_cash_balance(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)


@query("extract_contract_status")
def q_extract_contract_status(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_contract_status(t.raw_snapshots, t.raw_status_options, t.raw_suppliers)


@query("extract_suppliers")
def q_extract_suppliers(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_suppliers(t.raw_suppliers, t.raw_snapshots, t.raw_status_options)


@query("extract_customers")
def q_extract_customers(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return ex.extract_customers(t.raw_customers, t.raw_customer_types, t.raw_ndg)


@query("extract_ndg")
def q_extract_ndg(spark, sf_dir):
    return ex.extract_ndg(Tables.for_run(spark, sf_dir).raw_ndg)


# ---------------------------------------------------------------------------
# sinks and state
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402
from decimal import Decimal  # noqa: E402

from ..params import CONSTANTS  # noqa: E402
from ..sources import publish as pub  # noqa: E402


@query("load_csv_positional")
def q_load_csv_positional(spark, sf_dir):
    """Export the customer dimension as CSV with a leading index column, load it back by position."""
    t = Tables.for_run(spark, sf_dir)
    src = q_extract_customers(spark, sf_dir)
    path = pub.shared_dir(spark, "exports", "crm_customers")
    pub.export_csv(src, path)
    return pub.load_csv_positional(spark, path, src.schema)


@query("publish_with_audit")
def q_publish_with_audit(spark, sf_dir):
    """Publish the pair metrics for three dates; the second is run again with fewer rows, the third with none.
    History has one folder a date and a rerun replaces its own, so no row of a replaced run is left."""
    t = Tables.for_run(spark, sf_dir)
    base = pub.shared_dir(spark, "published", "pair_metrics")
    snap = pairs(t).select(*PAIR_KEYS, "total_invoice", "total_ar", "risk_balance")
    one, two, three = (P.processing_date + _dt.timedelta(days=d) for d in (-1, 0, 1))
    for day, rows in ((one, snap), (two, snap), (two, snap.filter("total_ar > 0")), (three, snap), (three, snap.limit(0))):
        pub.publish_with_audit(rows, base, day)
    now = pub.read_current(spark, base).select(F.lit(three).alias("processing_date"))
    return (pub.read_history(spark, base).select("processing_date").unionByName(now).groupBy("processing_date")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("constants_upsert")
def q_constants_upsert(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return pub.constants_upsert(t.raw_constant_values, CONSTANTS, P.processing_date)


@query("state_two_days")
def q_state_two_days(spark, sf_dir):
    """Constants of two days' runs, the second run twice: each run starts from the state stored before it."""
    t = Tables.for_run(spark, sf_dir)
    state = daily.State(spark, pub.shared_dir(spark, "state", "two-days"))
    for day in (P.processing_date, P.processing_date + _dt.timedelta(days=1), P.processing_date + _dt.timedelta(days=1)):
        state.constants(day, t.raw_constant_values)
    return state.store("constant_values").history().select("processing_date", "id", "value", "value_date")


@query("reason_state_two_days")
def q_reason_state_two_days(spark, sf_dir):
    """Reason weights that the second day's run reads: what the first published, over the input's."""
    t = Tables.for_run(spark, sf_dir)
    state = daily.State(spark, pub.shared_dir(spark, "state", "reasons"))
    state.store("supplier_reason").publish(REGISTRY["reason_weight_update"](spark, sf_dir), P.processing_date)
    out = state.reasons("supplier", t.supplier_reason, P.processing_date + _dt.timedelta(days=1))
    return r6(out, "weight")


# ---------------------------------------------------------------------------
# typed loads
# ---------------------------------------------------------------------------
from ..functions.scalar import units  # noqa: E402
from ..sources import loads  # noqa: E402
from . import daily, job  # noqa: E402


def load_source(t: Tables, name: str) -> DataFrame:
    """A relation with the columns of its load, in file order (columns that the test data lacks are null)."""
    return loads.in_file_order(t[name], name)


@query("load_all")
def q_load_all(spark, sf_dir):
    """All eleven files of a day written as CSV and loaded: rows read, loaded and rejected, and rows in the table after the load is done again."""
    t = Tables.for_run(spark, sf_dir)
    folder = pub.shared_dir(spark, "exports", "all")
    for name in loads.LOADS:
        pub.export_csv(load_source(t, name), f"{folder}/{name}", compression="gzip")
    house = loads.Warehouse(spark, pub.shared_dir(spark, "warehouse", "all"))
    house.load("crm_ndg", f"{folder}/crm_ndg", P.processing_date - _dt.timedelta(days=1))
    house.load("open_payable", f"{folder}/open_payable", P.processing_date - _dt.timedelta(days=1))
    house.load("open_payable", f"{folder}/open_payable", P.processing_date)
    done = spark.createDataFrame([(x.name, x.rows, x.loaded, x.rejected) for x in house.load_all(folder, P.processing_date)],
                                 "load string, n_rows long, n_loaded long, n_rejected long")
    held = None
    for name in loads.LOADS:
        row = _held(house.table(name), name, "n_table")
        held = row if held is None else held.unionByName(row)
    return done.join(held, "load")


def _held(df, name, n):
    """Rows of a loaded table and the sums of its amounts, dates and ids."""
    kinds = [(f.name, f.dataType.simpleString()) for f in loads.LOADS[name].schema]
    money = [units(c) for c, k in kinds if k == "double"]
    days = [F.datediff(c, F.lit(_dt.date(1990, 1, 1))) for c, k in kinds if k == "date"]
    ids = [F.col(c) for c, k in kinds if k in ("bigint", "int")]
    return df.agg(F.lit(name).alias("load"), F.count(F.lit(1)).alias(n), _added(money).alias("units"), _added(days).alias("days"),
                  _added(ids).alias("ids"))


def _added(cols):
    """Sum of the columns' sums, nulls as 0, as a long.

    The ids of a large table add up to more than a long holds, so the sums are decimals; beyond a long the column has the total modulo 2^64
    (two's complement), which still changes with any id.
    """
    out = F.lit(0).cast("decimal(38,0)")
    for c in cols:
        out = (out + F.coalesce(F.sum(c.cast("decimal(19,0)")), F.lit(0))).cast("decimal(38,0)")
    span = F.lit(Decimal(1 << 64)).cast("decimal(38,0)")
    low = F.pmod(out, span)
    return F.when(low < Decimal(1 << 63), low).otherwise(low - span).cast("long")


def spoiled(src: DataFrame) -> DataFrame:
    """Invoice rows of which some cannot be read: amounts, dates and ids as text that is none."""
    n, text = F.col("invoice_num"), lambda c: F.col(c).cast("string")
    return src.withColumns({"txn_amount": F.when(n % 7 == 0, F.concat(text("txn_amount"), F.lit("x"))).otherwise(text("txn_amount")),
                            "invoice_date": F.when(n % 11 == 0, F.lit("2001-02-30")).otherwise(text("invoice_date")),
                            "customer_id": F.when(n % 13 == 0, F.lit("none")).otherwise(text("customer_id"))})


@query("load_rejects")
def q_load_rejects(spark, sf_dir):
    """The invoice file with unreadable values: rejected rows by column and number of reasons, beside the loaded rows."""
    t = Tables.for_run(spark, sf_dir)
    path = pub.shared_dir(spark, "exports", "spoiled")
    pub.export_csv(spoiled(load_source(t, "invoice_payments")), path, compression="gzip")
    house = loads.Warehouse(spark, pub.shared_dir(spark, "warehouse", "spoiled"))
    house.load("invoice_payments", path, P.processing_date)
    by = (house.rejects("invoice_payments").select(F.size("reasons").alias("n_reasons"), F.explode("reasons").alias("r"))
          .groupBy("n_reasons", F.substring_index("r", ":", 1).alias("column")).agg(F.count(F.lit(1)).alias("n")))
    good = house.table("invoice_payments").agg(F.lit(0).alias("n_reasons"), F.lit("").alias("column"), F.count(F.lit(1)).alias("n"))
    return by.unionByName(good)


@query("job_loads")
def q_job_loads(spark, sf_dir):
    """Two days of the job up to its loads, the second day run twice: rows and sums of every table after the load."""
    house = _two_days(spark, sf_dir)
    held = None
    means = {"open_payable": ["open_payable"], "unapplied_balance": ["unapplied_amount"]}     # rounded as in their extractions' rows
    for name in loads.LOADS:
        row = _held(r6(house.table(name), *means.get(name, ())), name, "n_table")
        held = row if held is None else held.unionByName(row)
    return held


@query("job_pair_metrics")
def q_job_pair_metrics(spark, sf_dir):
    """Pair metrics of tables that were extracted and loaded on two days."""
    house = _two_days(spark, sf_dir)
    t = loads.WarehouseTables(spark, sf_dir, house, P.processing_date)
    return metrics.pair_metrics(clean.unified_ledger(t.invoice_payments, t.chargebacks, DEFAULT), DEFAULT)


def _two_days(spark, sf_dir) -> loads.Warehouse:
    """The warehouse after the job's loads of the day before (everything from the window's start) and of the processing date."""
    t = Tables.for_run(spark, sf_dir)
    if "_two_days" not in t.__dict__:       # both rows read the same warehouse
        work = job.Job(spark, t, pub.shared_dir(spark, "job", "two-days"), P, first_day=W_START)
        for day in (P.processing_date - _dt.timedelta(days=1), P.processing_date, P.processing_date):
            work.load_day(day)
        t._two_days = work.house
    return t._two_days


@query("scan_window_partitioned")
def q_scan_window_partitioned(spark, sf_dir):
    """The window scan over the invoice facts partitioned by date: the date range chooses folders, the amount is a stored column."""
    src = Tables.for_run(spark, sf_dir).invoice_payments
    path = pub.shared_dir(spark, "facts", "invoice_payments")
    loads.write_by_date(src, path, "invoice_date", ["invoice_num"], files=1)
    return clean.scan_window(loads.read_by_date(spark, path, src.schema), "invoice_date").select(*INVOICE_VIEW)


# ---------------------------------------------------------------------------
# published detail and exports
# ---------------------------------------------------------------------------
from ..sources import exports  # noqa: E402
from .pipeline import DETAIL_COLUMNS, export_frames  # noqa: E402


@query("pair_detail_full")
def q_pair_detail_full(spark, sf_dir):
    """Pair detail as published: every metric, both predictions, score, exposure, wallet, risk balances and contract status."""
    t = Tables.for_run(spark, sf_dir)
    return _round_doubles(sup.pair_detail(cust_pairs(t), _dim(t), t.contract_status, DETAIL_COLUMNS))


def _round_doubles(df: DataFrame) -> DataFrame:
    return r6(df, *[c for c, tp in df.dtypes if tp == "double"])


def exported(spark, t: Tables, name: str) -> DataFrame:
    """One of the six exports, written as CSV under published names and read back by position."""
    df = export_frames(ledger(t), pairs(t), cust_pairs(t), _supplier_pair_scores(spark, t), _supplier_totals(t), test_weights(spark), P)[name]
    folder = pub.shared_dir(spark, "exports", "published")
    schema = exports.write_export(df, folder, name, P.processing_date)
    return _round_doubles(exports.read_export(spark, folder, name, schema))


def _export_query(name: str):
    return lambda spark, sf_dir: exported(spark, Tables.for_run(spark, sf_dir), name)


for _name in exports.FILES:
    REGISTRY[f"export_{_name}"] = _export_query(_name)


# ---------------------------------------------------------------------------
# the customer x supplier scores slice by slice
# ---------------------------------------------------------------------------
from ..operators import cross_slices  # noqa: E402

N_SLICES = 8


def _sliced(spark, t: Tables) -> cross_slices.SlicedCross:
    slices = t.stage("customer_slices", lambda: cross_slices.customer_slices(t.crm_customers, N_SLICES))
    return cross_slices.SlicedCross(cross_inputs(spark, t), slices)


@query("slice_bounds")
def q_slice_bounds(spark, sf_dir):
    return (_sliced(spark, Tables.for_run(spark, sf_dir)).slices.groupBy("slice")
            .agg(F.min("customer_id").alias("first_id"), F.max("customer_id").alias("last_id"), F.count(F.lit(1)).alias("n_customers")))


@query("slice_centroids")
def q_slice_centroids(spark, sf_dir):
    return _sliced(spark, Tables.for_run(spark, sf_dir)).cents


@query("slice_values")
def q_slice_values(spark, sf_dir):
    return _sliced(spark, Tables.for_run(spark, sf_dir)).value_table().select(
        "slice", "c_val", "s_val", "n_c", "n_s", "cluster", "i_comb", "i_cust", "i_sup", "combined_score", "combined_level")


@query("slice_name_means")
def q_slice_name_means(spark, sf_dir):
    sliced = _sliced(spark, Tables.for_run(spark, sf_dir))
    out = None
    for entity in ("supplier", "customer"):
        one = sliced.name_means(entity).select(F.lit(entity).alias("entity"), "slice", F.col(f"{entity}_id").alias("id"), "n_history", "mean_score",
                                               "level")
        out = one if out is None else out.unionByName(one)
    return r6(out, "mean_score")


# ---------------------------------------------------------------------------
# the other side of one-sided updates, groups, the excluded supplier
# ---------------------------------------------------------------------------
@query("extract_ndg")
def q_extract_ndg(spark, sf_dir):
    return ex.extract_ndg(Tables.for_run(spark, sf_dir).raw_ndg)


@query("latest_override_customer")
def q_latest_override_customer(spark, sf_dir):
    return ovr.latest_override(Tables.for_run(spark, sf_dir).customer_update_level, "customer_id")


@query("reason_weight_update_customer")
def q_reason_weight_update_customer(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    return r6(ovr.reason_weight_update(customer_reasons(t), customer_overrides(t), "customer_id"), "weight")


@query("reason_missing_rows_supplier")
def q_reason_missing_rows_supplier(spark, sf_dir):
    t = Tables.for_run(spark, sf_dir)
    matrix = ovr.reason_matrix(t.crm_classes, "supplier_id", t.override_reasons)
    return ovr.reason_missing_rows(matrix, t.supplier_reason, "supplier_id")


@query("override_nonhistorical_supplier")
def q_override_nonhistorical_supplier(spark, sf_dir):
    """Suppliers of the product after the update from their aggregate scores and the overrides of those without history."""
    t = Tables.for_run(spark, sf_dir)
    _, _, finals = _entity_finals(spark, t)
    scores = supplier_overrides(spark, t)
    updated = cross.update_from_join(finals, scores, "supplier_id", "supplier")
    latest = ovr.latest_override(t.supplier_update_level, "supplier_id")
    return r6(cross.override_nonhistorical(updated, latest, scores, "supplier_id", "supplier"), "supplier_score")


EXCLUDED = "Supplier#000000001"


@query("excluded_supplier_exposure")
def q_excluded_supplier_exposure(spark, sf_dir):
    """The supplier side of a run that leaves one supplier out by name."""
    t = Tables.for_run(spark, sf_dir)
    p = dataclasses.replace(P, excluded_supplier=EXCLUDED)
    return sup.supplier_pairs(pair_frame(t), _dim(t), p).select(*SP_COLS)
