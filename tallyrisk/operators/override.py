"""Human level overrides and override reasons.

The reference applies overrides one entity at a time; here every overridden
entity is handled by the same joins at once, so each entity's result depends
only on its own rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import level_max, level_min
from ..params import DEFAULT_REASON_WEIGHT


def latest_override(update_level: DataFrame, key: str) -> DataFrame:
    """Latest override row per entity (by ``updated_at``; ties: higher level, then reason)."""
    order = F.struct(F.col("updated_at"), F.col("new_level"), F.col("reason"))
    row = F.struct("new_level", "reason", "previous_level", "updated_at")
    return (update_level.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max_by(row, order).alias("o"))
            .select(key, "o.new_level", "o.reason", F.col("o.previous_level").alias("requested_previous_level"),
                    "o.updated_at"))


def reason_matrix(entities: DataFrame, key: str, reasons: DataFrame) -> DataFrame:
    """Every entity with every reason of the input list at the default weight (one row each is the result)."""
    return (entities.select(key).filter(F.col(key).isNotNull()).distinct()
            .crossJoin(reasons.select("reason").distinct()).withColumn("weight", F.lit(DEFAULT_REASON_WEIGHT)))


def reason_missing_rows(matrix: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of the reason matrix for entities that have no reason rows yet (weight 0.1)."""
    return matrix.join(existing.select(key).distinct(), key, "left_anti")


def reason_weight_lookup(overrides: DataFrame, reasons: DataFrame, key: str) -> DataFrame:
    """Weight of the entity's reason row whose text starts with the override reason.

    Equi-join on the entity id with a ``startswith`` residual; several matches
    take the alphabetically first reason text.
    """
    r = reasons.select(F.col(key).alias("__k"), F.col("reason").alias("__reason"), F.col("weight").alias("__w"))
    j = overrides.join(r, (overrides[key] == r["__k"]) & F.col("__reason").startswith(overrides["reason"]), "left")
    return (j.groupBy(key, "reason").agg(F.min_by("__w", "__reason").alias("reason_weight")))


def apply_overrides(scores: DataFrame, key: str, latest: DataFrame, weights: DataFrame, norm: DataFrame,
                    metrics: Sequence[str], reasons: DataFrame, c: float, std_from: DataFrame | None = None,
                    weighted: Sequence[str] | None = None) -> DataFrame:
    """Move overridden entities to their new level and re-score them inside it.

    With ``sd`` the sample std of all scores and the new level's range [lo, hi]:
    interim = round(hi - c*sd) when the level goes down, else round(lo + c*sd);
    the external factor = reason weight * interim / old score + 0.0001; the
    entity's metric weights (of ``weighted``, by default ``metrics``: an entity may have
    weights of metrics that its score leaves out) and the external factor are rescaled to sum 1; the
    final score = round(((sum(n * w) + factor + 10) / 20) * (hi - lo) + lo).
    Entities without an override keep their score, previous score/level = -1.
    """
    sd = (std_from if std_from is not None else scores).agg(F.stddev_samp("score").alias("__sd"))
    weighted = metrics if weighted is None else weighted
    ov = latest.join(scores.select(key), key, "left_semi")
    rw = reason_weight_lookup(ov, reasons, key)
    # only overridden entities are scored anew; the rest pass by
    j = (scores.select(key, "score", "level").join(ov.select(key, "new_level", "reason"), key)
         .join(rw, [key, "reason"], "left")
         .join(weights.select(key, *["w_" + m for m in weighted]), key, "left")
         .join(norm.select(key, *["n_" + m for m in metrics]), key, "left")
         .crossJoin(F.broadcast(sd)))
    c_ = F.col
    lo, hi = level_min(c_("new_level")), level_max(c_("new_level"))
    down = c_("new_level") < c_("level")
    interim = F.when(down, F.bround(hi - c * c_("__sd"), 0)).otherwise(F.bround(lo + c * c_("__sd"), 0))
    factor = F.try_divide(c_("__interim"), c_("score"))
    ext = F.coalesce(c_("reason_weight"), F.lit(DEFAULT_REASON_WEIGHT)) * factor + 0.0001
    total = None
    for m in weighted:
        total = c_("w_" + m) if total is None else total + c_("w_" + m)
    total = total + c_("__ext")
    # each step is a column of its own, so that no step's expression is repeated in the next
    j = j.withColumn("__interim", interim).withColumn("__ext", ext).withColumn("__total", total)
    scale = F.when(c_("__total").isNull(), F.lit(None)).when(c_("__total") != 0, c_("__total")).otherwise(F.lit(1.0))
    j = j.withColumn("__scale", scale)
    ext_n = F.coalesce(c_("__ext") / c_("__scale"), F.lit(DEFAULT_REASON_WEIGHT))
    updated = None
    for m in metrics:
        term = F.coalesce(c_("n_" + m) * (c_("w_" + m) / c_("__scale")), F.lit(0.0))
        updated = term if updated is None else updated + term
    updated = updated + ext_n
    final = F.bround(((updated + 10) / 20) * (hi - lo) + lo, 0)
    has = c_("new_level").isNotNull()
    moved = j.select(
        key,
        F.when(has, c_("score")).otherwise(F.lit(-1.0)).alias("previous_score"),
        F.when(has, c_("level")).otherwise(F.lit(-1)).cast("int").alias("previous_level"),
        F.when(has, final).otherwise(c_("score")).alias("score"),
        F.when(has, c_("new_level")).otherwise(c_("level")).cast("int").alias("level"),
        F.when(has, F.lit(1)).otherwise(F.lit(0)).alias("is_flagged"),
        F.when(has, c_("__interim")).alias("interim_score"),
        F.when(has, ext_n).alias("external_factor"),
        "reason",
    )
    kept = scores.join(ov.select(key), key, "left_anti").select(
        key, F.lit(-1.0).alias("previous_score"), F.lit(-1).alias("previous_level"), c_("score"), c_("level").cast("int").alias("level"),
        F.lit(0).alias("is_flagged"), F.lit(None).cast("double").alias("interim_score"),
        F.lit(None).cast("double").alias("external_factor"), F.lit(None).cast("string").alias("reason"))
    return moved.unionByName(kept)


def reason_weight_update(reasons: DataFrame, overridden: DataFrame, key: str) -> DataFrame:
    """Reason table with the rescaled external factor written back (exact reason match)."""
    upd = (overridden.filter(F.col("external_factor").isNotNull())
           .select(key, "reason", F.col("external_factor").alias("__new")))
    j = reasons.join(upd, [key, "reason"], "left")
    return j.select(key, "reason", F.coalesce(F.col("__new"), F.col("weight")).alias("weight"))
