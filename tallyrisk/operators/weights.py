"""Data-driven metric weights: correlation with risk balance, sign forcing, fixed fallback."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import (NEGATIVE_METRICS, PAIR_FIXED_WEIGHTS, PAIR_METRICS, POSITIVE_METRICS, ZEROED_METRICS)
from .normalize import grouped


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; undefined (constant, <2 rows) -> null.

    Written as ``covar_samp / (sd_x * sd_y)`` because the built-in ``corr``
    raises on a zero denominator under ANSI mode.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    den = F.stddev_samp(xs) * F.stddev_samp(ys)
    degenerate = (F.max(xs) == F.min(xs)) | (F.max(ys) == F.min(ys))
    return F.when(~degenerate & (den != 0), F.covar_samp(xs, ys) / den)


def force_sign(metric: str, value: Column, positive=POSITIVE_METRICS, negative=NEGATIVE_METRICS,
               zeroed=ZEROED_METRICS) -> Column:
    if metric in zeroed:
        return F.lit(0.0)
    if metric in positive:
        return F.abs(value)
    if metric in negative:
        return -F.abs(value)
    return value


def corr_exprs(metrics: Sequence[str] = PAIR_METRICS, target: str = "risk_balance",
               prefix: str = "corr_") -> dict[str, Column]:
    """Aggregate expressions: correlation of each metric with ``target`` (undefined -> 0)."""
    return {prefix + m: F.coalesce(pearson(m, target), F.lit(0.0)) for m in metrics}


def weight_exprs(fixed: Column, metrics: Sequence[str] = PAIR_METRICS, fixed_weights=PAIR_FIXED_WEIGHTS,
                 target: str = "risk_balance", zeroed=ZEROED_METRICS, prefix: str = "w_") -> dict[str, Column]:
    """Aggregate expressions for the weights: the fixed table where ``fixed`` else sign-forced correlations."""
    out = {}
    for m, fw in zip(metrics, fixed_weights):
        corr = F.coalesce(pearson(m, target), F.lit(0.0))
        out[prefix + m] = F.when(fixed, F.lit(float(fw))).otherwise(force_sign(m, corr, zeroed=zeroed))
    return out


def customer_weight_exprs() -> dict[str, Column]:
    """Per-customer weights: fixed when every risk balance <= 0 or the customer has one supplier."""
    fixed = (F.max("risk_balance") <= 0) | (F.count(F.lit(1)) == 1)
    return weight_exprs(fixed)


def customer_corr_weights(pairs: DataFrame) -> DataFrame:
    """Raw correlation of each pair metric with the risk balance, per customer."""
    return grouped(pairs, ["customer_id"], [e.alias(n) for n, e in corr_exprs().items()])


def customer_weights(pairs: DataFrame) -> DataFrame:
    """Final per-customer weights (one row per customer, ``w_<metric>`` columns)."""
    return grouped(pairs, ["customer_id"], [e.alias(n) for n, e in customer_weight_exprs().items()])
