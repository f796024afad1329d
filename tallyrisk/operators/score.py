"""Scores 0..800 and risk levels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clamp, level_of
from ..params import (DEFAULT, INTERNATIONAL_SCALE, NEGATIVE_METRICS, PAIR_METRICS, PAIR_SCALE,
                      POSITIVE_METRICS, Params)
from . import normalize, weights


def weighted_sum(metrics: Sequence[str], norm_prefix: str = "n_", weight_prefix: str = "w_") -> Column:
    """``sum(n_m * w_m)`` with a missing term counted as 0, in metric order."""
    total = None
    for m in metrics:
        term = F.coalesce(F.col(norm_prefix + m) * F.col(weight_prefix + m), F.lit(0.0))
        total = term if total is None else total + term
    return total


def linear(s: Column, scale: tuple[float, float]) -> Column:
    return (s + scale[0]) * scale[1]


def customer_normalised(pairs: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """Normalised pair metrics (``n_<metric>``) within each customer, plus ``n_pairs``.

    Customers with several suppliers: z-score, zero mask, offset min-max over the
    customer's pairs (one aggregate, one join back).  Single-supplier customers: the positive and
    the negative metrics are z-scored against each other within the row
    (population std), zero-masked and made absolute; the remaining metrics keep
    their min-max value (1 when the raw value is not 0).
    """
    mm = normalize.masked_minmax(pairs, PAIR_METRICS, ["customer_id"], extra=[F.count(F.lit(1)).alias("n_pairs"), *extra])
    single = F.col("n_pairs") == 1
    cols, names = {}, mm.columns
    for name, group in (("positive", POSITIVE_METRICS), ("negative", NEGATIVE_METRICS)):
        mm, z = normalize.rowwise_z(mm, name, group)
        for m in group:
            cols["n_" + m] = F.when(single, F.abs(F.when(F.col(m) == 0, F.lit(0.0)).otherwise(z[m]))).otherwise(F.col("n_" + m))
    return mm.withColumns(cols).select(*names)


def pair_scores(pairs: DataFrame, customer_type: str = "customer_type_id", p: Params = DEFAULT) -> DataFrame:
    """Pair score: weighted normalised metrics -> linear map by customer type -> round -> clamp -> level.

    All per-customer statistics (counts, z-score and min-max statistics, weights) come from one partially
    aggregated ``groupBy`` and one join back on customer_id.
    """
    withw = customer_normalised(pairs, [e.alias(n) for n, e in weights.customer_weight_exprs().items()])
    s = weighted_sum(PAIR_METRICS)
    raw = F.when(F.col(customer_type) == p.international_type_id, linear(s, INTERNATIONAL_SCALE)) \
        .otherwise(linear(s, PAIR_SCALE))
    scored = withw.withColumn("score_raw", raw).withColumn("score", clamp(F.bround(F.col("score_raw"), 0)))
    return scored.withColumn("level", level_of(F.col("score")))


def level_buckets(scored: DataFrame, score: str = "score") -> DataFrame:
    """Count, min and max score per level (a level-distribution report)."""
    return (scored.groupBy(level_of(F.col(score)).alias("level"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("min_score"), F.max(score).alias("max_score")))
