"""Customer and customer-group (ndg) roll-ups and their scores.

One roll-up function serves both keys.  Global statistics (min/max over all
customers, score std) are single-row aggregates broadcast back — never an
unpartitioned window.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clamp, clamp_replace, from_units, level_of, units
from ..params import (AGG_SCALE, CUSTOMER_AGG_METRICS, DEFAULT, GROUP_FIXED_WEIGHTS, MEAN_METRICS,
                      NEGATIVE_METRICS, PAIR_METRICS, POSITIVE_METRICS, Params)
from . import normalize
from .score import linear, weighted_sum
from .supplier import entity_attributes
from .weights import weight_exprs

MONEY_SUMS = ("total_invoice", "early_payment_amount", "open_ar", "outstanding_balance", "delinquent_payment_lt10",
              "delinquent_payment_gt10", "chargeback_vol_amt", "chargeback_vol_paid", "chargeback_vol_unpaid",
              "overdue_chargebacks", "early_chargeback", "risk_balance", "total_ar", "open_chargeback_vol_amt",
              "predict_ar_10d", "predict_ar_30d")
COUNT_SUMS = ("invoice_freq", "suppliers_freq", "chargeback_freq", "supplier_wo_overdue_cb", "supplier_w_overdue_cb",
              "open_chargeback_freq", "num_supplier_w_open_invoice")
RATIO_SUMS = ("payment_timeliness_ratio", "late_payment_ratio_lt10", "late_payment_ratio_gt10")
RATIOS = RATIO_SUMS


def _exact(c: str):
    """Sum of a ratio, a percentage or days in steps of 1e-12: the same whatever the order of the rows."""
    return F.sum(F.col(c).cast("decimal(28,12)"))


def aggregate_metrics(scored: DataFrame, key: str, attrs: Sequence[str] = ()) -> DataFrame:
    """Roll pair metrics up to ``key``: 26 sums, 11 means, invoice-weighted dbt and payment cycle.

    The three timeliness ratios are rescaled to sum to 100 (a zero sum counts
    as 1), unpaid = total AR / total invoice * 100 and paid = 100 - unpaid
    (both 0 when undefined).
    """
    ti = units("total_invoice").cast("decimal(20,0)")
    agg = normalize.grouped(scored.filter(F.col(key).isNotNull()), [key], [
        *[from_units(F.sum(units(c))).alias(c) for c in MONEY_SUMS],
        *[F.sum(c).cast("long").alias(c) for c in COUNT_SUMS],
        *[_exact(c).cast("double").alias("__" + c) for c in RATIO_SUMS],
        *[F.try_divide(_exact(c).cast("double"), F.count(c)).alias(c) for c in MEAN_METRICS],
        F.sum(ti * F.col("dbt").cast("decimal(12,0)")).alias("__dbt_num"),
        F.sum(ti * F.col("payment_cycle").cast("decimal(12,0)")).alias("__pc_num"),
        F.sum(ti).alias("__ti"),
    ])
    if attrs:
        agg = agg.join(entity_attributes(scored, key, attrs), key, "left")
    s = F.col("__" + RATIO_SUMS[0]) + F.col("__" + RATIO_SUMS[1]) + F.col("__" + RATIO_SUMS[2])
    s = F.when(s == 0, F.lit(1.0)).otherwise(s)
    unpaid = F.coalesce(F.try_divide(units("total_ar").cast("double"), units("total_invoice").cast("double")) * 100,
                        F.lit(0.0))
    return agg.select(
        *[c for c in agg.columns if not c.startswith("__")],
        *[(F.col("__" + c) / s * 100).alias(c) for c in RATIO_SUMS],
        F.coalesce(F.bround(F.try_divide(F.col("__dbt_num").cast("double"), F.col("__ti").cast("double")), 0),
                   F.lit(0.0)).alias("dbt"),
        F.coalesce(F.bround(F.try_divide(F.col("__pc_num").cast("double"), F.col("__ti").cast("double")), 0),
                   F.lit(0.0)).alias("payment_cycle"),
        unpaid.alias("unpaid_invoice"),
        F.when(F.try_divide(units("total_ar").cast("double"), units("total_invoice").cast("double")).isNull(),
               F.lit(0.0)).otherwise(F.lit(100.0) - unpaid).alias("paid_invoice"),
    )


def global_minmax(df: DataFrame, metrics: Sequence[str], prefix: str = "g_") -> DataFrame:
    """Plain min-max over the whole table (undefined -> 0), statistics broadcast as one row."""
    stats = df.agg(*[F.min(m).alias(f"__lo_{m}") for m in metrics], *[F.max(m).alias(f"__hi_{m}") for m in metrics])
    j = df.crossJoin(F.broadcast(stats))
    return j.select(*df.columns, *[
        F.coalesce(F.try_divide(F.col(m) - F.col(f"__lo_{m}"), F.col(f"__hi_{m}") - F.col(f"__lo_{m}")),
                   F.lit(0.0)).alias(prefix + m) for m in metrics])


def agg_customer_score(agg: DataFrame, cust_weights: DataFrame, p: Params = DEFAULT,
                       metrics: Sequence[str] = CUSTOMER_AGG_METRICS) -> DataFrame:
    """Customer score from the roll-up: global min-max of 15 metrics (payment cycle taken
    as dbt), weighted by the customer's own weights (payment-cycle weight made <= 0),
    weighted sum min-maxed over all customers to 0..800 (international: 0..240),
    out-of-range replaced (10 / 780), level."""
    df = agg.withColumn("payment_cycle", F.col("dbt"))
    df = df.join(cust_weights.select("customer_id", *["w_" + m for m in metrics]), "customer_id", "left")
    df = df.withColumn("w_payment_cycle", F.when(F.col("w_payment_cycle") > 0, -F.col("w_payment_cycle"))
                       .otherwise(F.col("w_payment_cycle")))
    normed = global_minmax(df, metrics, prefix="n_")
    ws = normed.withColumn("ws", weighted_sum(metrics))
    st = ws.agg(F.min("ws").alias("__wlo"), F.max("ws").alias("__whi"))
    j = ws.crossJoin(F.broadcast(st))
    frac = F.try_divide(F.col("ws") - F.col("__wlo"), F.col("__whi") - F.col("__wlo"))
    s800 = clamp_replace(F.bround(frac * 800, 0))
    s240 = clamp_replace(F.bround(frac * 240, 0))
    score = F.when(F.col("customer_type_id") == p.international_type_id, s240).otherwise(s800)
    out = j.withColumn("score", score).drop("__wlo", "__whi")
    return out.withColumn("level", level_of(F.col("score")))


def international_adjust(scored: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """International customers: ``round(anchor + (score - 250) + c2 * std)``; level recomputed.

    ``anchor`` is the score of the smallest customer id and ``std`` the sample std
    of all scores (both one-row aggregates).  The result is not clamped; a score
    outside 0..800 gets no level.
    """
    st = scored.agg(F.stddev_samp("score").alias("__sd"),
                    F.min_by("score", "customer_id").alias("__anchor"))
    j = scored.crossJoin(F.broadcast(st))
    adj = F.bround(F.col("__anchor") + (F.col("score") - 250) + p.c("c2") * F.col("__sd"), 0)
    out = j.withColumn("score", F.when(F.col("customer_type_id") == p.international_type_id, adj)
                       .otherwise(F.col("score"))).drop("__sd", "__anchor")
    return out.withColumn("level", level_of(F.col("score")))


GROUP_POSITIVE = POSITIVE_METRICS
GROUP_NEGATIVE = NEGATIVE_METRICS


def ndg_score_raw(ndg_agg: DataFrame, modal: DataFrame, metrics: Sequence[str] = PAIR_METRICS) -> DataFrame:
    """Group score within its modal-level bucket.

    Bucket weights: the fixed group table when every risk balance is 0 or the
    bucket has one group, else correlations with risk balance, sign-forced
    (nothing zeroed).  Metrics are z-scored in the bucket (undefined -> 0), the
    15 signed metrics made absolute, ``(sum + 3) * 133.3333``, round, clamp, level.
    """
    df = ndg_agg.join(modal, "ndg_id", "left")
    fixed = (F.max(F.abs(F.col("risk_balance"))) == 0) | (F.count(F.lit(1)) == 1)
    wexpr = weight_exprs(fixed, metrics, GROUP_FIXED_WEIGHTS, zeroed=())
    w = df.groupBy("modal_level").agg(*[e.alias(n) for n, e in wexpr.items()])
    z = normalize.zscore(df, metrics, ["modal_level"], prefix="z_")
    signed = set(GROUP_POSITIVE) | set(GROUP_NEGATIVE)
    z = z.withColumns({"z_" + m: F.abs(F.col("z_" + m)) for m in metrics if m in signed})
    j = z.join(w, "modal_level", "left")
    raw = linear(weighted_sum(metrics, norm_prefix="z_"), AGG_SCALE)
    out = (j.withColumn("score_raw", F.when(F.col("modal_level").isNotNull(), raw))
           .withColumn("score", clamp(F.bround(F.col("score_raw"), 0))))
    return out.withColumn("level", level_of(F.col("score")))


def customer_group_map(customers: DataFrame) -> DataFrame:
    """customer -> group (one row per customer)."""
    return customers.select("customer_id", "ndg_id").distinct()


def ndg_single_member(ndg_scores: DataFrame, cust_map: DataFrame, cust_scores: DataFrame) -> DataFrame:
    """Groups with exactly one member customer take that customer's score."""
    one = (cust_map.groupBy("ndg_id").agg(F.count(F.lit(1)).alias("n"), F.min("customer_id").alias("member"))
           .filter(F.col("n") == 1))
    member_score = one.join(cust_scores.select(F.col("customer_id").alias("member"), F.col("score").alias("ms")),
                            "member", "left")
    j = ndg_scores.join(member_score.select("ndg_id", "ms", "n"), "ndg_id", "left")
    return j.withColumn("score", F.when(F.col("n") == 1, F.col("ms")).otherwise(F.col("score"))).drop("ms", "n")


def ndg_score_spread(ndg_scores: DataFrame, cust_map: DataFrame, cust_scores: DataFrame) -> DataFrame:
    """Per group: min / max / mean of member customer scores and the group's own score."""
    j = (cust_map.join(ndg_scores.select("ndg_id", F.col("score").alias("old_ndg_score")), "ndg_id", "left")
         .join(cust_scores.select("customer_id", F.col("score").alias("cust_score")), "customer_id", "left"))
    return j.groupBy("ndg_id").agg(F.min("cust_score").alias("cust_min_score"),
                                   F.max("cust_score").alias("cust_max_score"),
                                   F.avg("old_ndg_score").alias("old_ndg_score"),
                                   F.avg("cust_score").alias("cust_mean_score"))


def ndg_final(ndg_scores: DataFrame, spread: DataFrame) -> DataFrame:
    """Blend group and member scores: ``mean - old / (max - min)``.

    max = min keeps the old score (0 when that is 0 or missing); group -1 gets 0;
    the value is truncated to an integer; a tight group (spread < 10) whose
    blend moves more than 30 from the mean keeps the old score; clamp; level.
    """
    c = F.col
    rng = c("cust_max_score") - c("cust_min_score")
    blend = c("cust_mean_score") - F.try_divide(c("old_ndg_score"), rng)
    same = rng == 0
    norm = (F.when(c("ndg_id") == -1, F.lit(0.0))
            .when(same, F.coalesce(c("old_ndg_score"), F.lit(0.0)))
            .otherwise(F.coalesce(blend, F.lit(0.0))))
    norm = F.when(F.isnan(norm), F.lit(0.0)).otherwise(norm).cast("long").cast("double")
    keep_old = (F.abs(c("cust_min_score") - c("cust_max_score")) < 10) & \
        (F.abs(c("cust_mean_score") - norm) > 30) & (c("ndg_id") != -1)
    final = F.when(F.coalesce(keep_old, F.lit(False)), c("old_ndg_score")).otherwise(norm)
    j = ndg_scores.drop("level").join(spread.select("ndg_id", "cust_min_score", "cust_max_score", "cust_mean_score",
                                                    "old_ndg_score"), "ndg_id", "left")
    out = j.withColumn("score", clamp(final))
    return out.withColumn("level", level_of(F.col("score")))
