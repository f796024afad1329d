"""One complete scoring run: every output table of a processing date, published with history.

Production settings: supplier weights are the fitted first principal
component, constants come from the stored state (refreshed or drawn for the
date).  Each published table is written once; intermediates reused by several
outputs are materialised once (``Tables.stage``).
"""
from __future__ import annotations

import dataclasses
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate as agg_ops
from ..operators import clean, cross, metrics, override, predict, score, supplier, weights
from ..params import CUSTOMER_AGG_METRICS, DEFAULT, PAIR_METRICS, SUPPLIER_METRICS, Params
from ..sources import exports, publish
from ..sources.tables import Tables

PAIR = ["customer_id", "supplier_id"]
#: attributes, metrics, predictions and score of a pair, as published
DETAIL_COLUMNS = (*metrics.ATTRIBUTE_COLUMNS, *metrics.METRIC_COLUMNS, "predict_ar_10d", "predict_ar_30d", "score", "level")


def run_scoring(spark: SparkSession, t: Tables, out_dir: str, p: Params = DEFAULT,
                stored_constants: DataFrame | None = None, reasons: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Compute and publish all outputs for ``p.processing_date``; returns table name -> path.

    ``reasons``: the stored reason weights of ``customer`` and ``supplier`` (default: the input tables).  See ``daily.run_day`` for a run that takes date, constants
    and reason weights from the state that earlier runs left.
    """
    reasons = reasons or {"customer": t.customer_reason, "supplier": t.supplier_reason}
    if stored_constants is not None:
        consts = publish.constants_upsert(stored_constants, publish.draw_constants(p.processing_date),
                                          p.processing_date)
        p = dataclasses.replace(p, constants={r.id: r.value for r in consts.collect()})   # 5 rows
    def stage(name, build):
        return t.stage(name, build, p)

    led = stage("run_ledger", lambda: clean.unified_ledger(
        *(t.within(n, p.window_start, p.processing_date) for n in ("invoice_payments", "chargebacks")), p))
    pm = stage("run_pairs", lambda: metrics.pair_metrics(led, p))
    scored = stage("run_scored", lambda: score.pair_scores(pm, p=p))
    preds = stage("run_predictions", lambda: predict.predict_open_pairs(led, pm, (10, 30), p))
    helpers = {"n_pairs", "score_raw", *(x + m for x in ("n_", "w_") for m in PAIR_METRICS)}
    pairs_out = stage("run_pairs_out", lambda: predict.with_predictions(scored.drop(*helpers), preds))

    # supplier side
    dim = stage("run_dim", lambda: supplier.supplier_dimension(t, p))
    frame = pairs_out.select(*PAIR, "supplier_name", "total_invoice", "open_ar", "total_ar", "outstanding_balance",
                             "score", "predict_ar_10d", "predict_ar_30d")
    totals = supplier.supplier_totals(supplier.supplier_rollup(frame, p), dim)
    w_row = supplier.weights_frame(spark, supplier.pca_weights(totals))
    sp = supplier.supplier_pairs(frame, dim, p)
    sp_scored = stage("run_sp_scored", lambda: supplier.supplier_pair_scores(sp, w_row))
    s_agg = supplier.agg_supplier_metrics(sp_scored.drop("score", "level", "score_raw"))
    s_modal = supplier.modal_level(sp_scored, "supplier_id")
    s_scores = stage("run_s_scores", lambda: supplier.agg_supplier_score(s_agg, s_modal, w_row))
    s_reasons = _reasons(reasons["supplier"], t.crm_classes, "supplier_id", t.override_reasons)
    s_final = stage("run_s_final", lambda: override.apply_overrides(
        s_scores, "supplier_id", override.latest_override(t.supplier_update_level, "supplier_id"),
        supplier.supplier_weights(s_scores, w_row), s_scores, SUPPLIER_METRICS, s_reasons, p.c("c1")))

    # customer and group side
    rows = predict.stacked_predictions(pm, preds)
    c_agg = agg_ops.aggregate_metrics(rows, "customer_id",
                                      ("ndg_id", "ndg_name", "customer_name", "customer_type_id", "customer_type"))
    c_scores = stage("run_c_scores", lambda: agg_ops.agg_customer_score(c_agg, weights.customer_weights(pm), p))
    c_adj = stage("run_c_adj", lambda: agg_ops.international_adjust(c_scores, p))
    c_reasons = _reasons(reasons["customer"], t.crm_customers, "customer_id", t.override_reasons)
    c_latest = override.latest_override(t.customer_update_level, "customer_id")
    c_final = stage("run_c_final", lambda: override.apply_overrides(
        c_adj, "customer_id", c_latest, weights.customer_weights(pm), c_scores, CUSTOMER_AGG_METRICS, c_reasons, p.c("c2"),
        std_from=c_scores, weighted=PAIR_METRICS))
    n_agg = agg_ops.aggregate_metrics(rows, "ndg_id")
    n_raw = agg_ops.ndg_score_raw(n_agg, supplier.modal_level(scored, "ndg_id"))
    cmap = agg_ops.customer_group_map(c_agg)
    n_members = agg_ops.ndg_single_member(n_raw, cmap, c_adj)
    n_final = agg_ops.ndg_final(n_members, agg_ops.ndg_score_spread(n_members, cmap, c_adj))

    # every customer x supplier combination (virtual: entity tables + history pairs)
    ci = cross.CrossInputs(t.crm_customers, t.crm_classes, c_final, s_final, scored, p)
    c_cross = stage("run_c_cross", lambda: cross.override_nonhistorical(
        cross.update_from_join(cross.entity_final(ci.name_means("customer"), "customer_id", "customer"),
                               c_final, "customer_id", "customer"), c_latest, c_final, "customer_id", "customer"))
    s_latest = override.latest_override(t.supplier_update_level, "supplier_id")
    s_cross = stage("run_s_cross", lambda: cross.override_nonhistorical(
        cross.update_from_join(cross.entity_final(ci.name_means("supplier"), "supplier_id", "supplier"),
                               s_final, "supplier_id", "supplier"), s_latest, s_final, "supplier_id", "supplier"))

    outputs = {
        "customer_supplier_score": pairs_out,
        "risk_factors": supplier.risk_factors(totals, w_row),
        "supplier_weights": w_row,
        "invoice_predictions_10d": predict.predict_invoices(led, pm, 10, p),
        "invoice_predictions_30d": predict.predict_invoices(led, pm, 30, p),
        "supplier_customer_score": sp_scored.select(*PAIR, "score", "level"),
        "agg_supplier_score": s_final,
        "agg_customer_score": c_final,
        "ndg_score": n_final.select("ndg_id", "score", "level"),
        "customer_weights": weights.customer_weights(pm),
        "supplier_reason": override.reason_weight_update(s_reasons, s_final, "supplier_id"),
        "customer_reason": override.reason_weight_update(c_reasons, c_final, "customer_id"),
        "cross_customer": c_cross.join(ci.cust.select("customer_id", F.col("val").alias("customer_value")), "customer_id", "left"),
        "cross_supplier": s_cross.join(ci.sup.select("supplier_id", F.col("val").alias("supplier_value")), "supplier_id", "left"),
        # score of any pair without history: its customer's and its supplier's value
        "cross_pair_values": ci.value_table().select("c_val", "s_val", "combined_score", "combined_level"),
        "cross_history_pairs": ci.finished_pairs(c_cross, s_cross),
        "historical_pairs": clean.historical_pairs(led),
        "supplier_customer_detail": supplier.pair_detail(pairs_out, dim, t.contract_status, DETAIL_COLUMNS),
    }
    paths = {}
    for name, df in outputs.items():
        paths[name] = os.path.join(out_dir, name)
        publish.publish_with_audit(df, paths[name], p.processing_date)
    files = export_frames(led, pm, pairs_out, sp_scored, s_scores, w_row, p)
    folder = os.path.join(out_dir, "exports", p.processing_date.isoformat())
    for name, df in files.items():
        exports.write_export(df, folder, name, p.processing_date)
        paths["export_" + name] = os.path.join(folder, exports.FILES[name])
    t.release()
    return paths


def export_frames(led: DataFrame, pm: DataFrame, pairs_out: DataFrame, sp_scored: DataFrame, suppliers: DataFrame, w_row: DataFrame,
                  p: Params) -> dict[str, DataFrame]:
    """The tables of the six exported files, before run columns and published names."""
    attributes = ["customer_id", "customer_name", "customer_type", "customer_type_id", "ndg_id", "ndg_name"]
    named = pm.select(*attributes).distinct().groupBy("customer_id").agg(*[F.max(a).alias(a) for a in attributes[1:]])
    return {
        "predictions_10d": predict.predict_invoice_detail(led, pm, 10, p),
        "predictions_30d": predict.predict_invoice_detail(led, pm, 30, p),
        "pair_scores": pairs_out.select(*DETAIL_COLUMNS),
        "customer_weights": weights.customer_weights(pm).join(named, "customer_id", "left"),
        "supplier_scores": sp_scored.select(*PAIR, "supplier_name", *[m for m in SUPPLIER_METRICS], "open_ar", "outstanding_balance", "predict_ar_10d",
                                            "predict_ar_30d", "score", "level"),
        "supplier_weights": supplier.supplier_weights(suppliers, w_row),
    }


def _reasons(existing: DataFrame, entities: DataFrame, key: str, reasons: DataFrame) -> DataFrame:
    matrix = override.reason_matrix(entities, key, reasons)
    return existing.unionByName(override.reason_missing_rows(matrix, existing, key))
