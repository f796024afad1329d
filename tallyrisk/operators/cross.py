"""Scores for every customer x supplier combination, without building the product.

For a pair with history the combined score is its pair score.  For a pair
without history the three scores (combined, customer, supplier) are imputed
from global statistics and the nearest of three cluster centroids, so they
depend only on the *values* of the customer's and the supplier's score — never
on the pair itself.  Scores are whole numbers in a small range, so the
distinct values form a small, bounded table.  Every quantity over the full
product is therefore computed from entity tables joined to value histograms:
the work grows linearly with customers + suppliers + history pairs, and no
customer x supplier product is ever materialised.  A pair's row is a lookup:
history pair table, else the imputation table keyed by (customer value,
supplier value).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import level_of, level_min
from ..params import DEFAULT, Params


def global_score_stats(cust_scores: DataFrame, sup_scores: DataFrame, pair_scores: DataFrame) -> DataFrame:
    """Mean and sample std of customer, supplier and pair (combined) scores — one row."""
    c = cust_scores.agg(F.avg("score").alias("customer_mean"), F.stddev_samp("score").alias("customer_std"))
    s = sup_scores.agg(F.avg("score").alias("supplier_mean"), F.stddev_samp("score").alias("supplier_std"))
    p = pair_scores.agg(F.avg("score").alias("combine_mean"), F.stddev_samp("score").alias("combine_std"))
    return c.crossJoin(s).crossJoin(p)


def history(pair_scores: DataFrame, cust_scores: DataFrame, sup_scores: DataFrame) -> DataFrame:
    """History pairs with their combined, customer and supplier scores."""
    return (pair_scores.select("customer_id", "supplier_id", F.col("score").alias("combined"))
            .join(cust_scores.select("customer_id", F.col("score").alias("cust")), "customer_id", "left")
            .join(sup_scores.select("supplier_id", F.col("score").alias("sup")), "supplier_id", "left"))


def centroid_columns() -> list[Column]:
    """Rounded mean (combined, customer, supplier) of history pairs per combined-score band, as aggregates."""
    c = F.col("combined")
    bands = {1: (c >= 0) & (c <= 250), 2: (c > 250) & (c <= 400), 3: (c > 400) & (c <= 800)}
    cols = []
    for k, cond in bands.items():
        for name, col in (("comb", "combined"), ("cust", "cust"), ("sup", "sup")):
            cols.append(F.bround(F.avg(F.when(cond, F.col(col))), 0).alias(f"k{k}_{name}"))
    return cols


def centroids(hist: DataFrame) -> DataFrame:
    """Rounded mean (combined, customer, supplier) of history pairs per combined-score band — one row."""
    return hist.agg(*centroid_columns())


def impute(comb0: Column, cust: Column, sup: Column) -> dict[str, Column]:
    """Nearest-centroid imputation (expects the centroid columns ``k{1,2,3}_*`` in scope).

    Distances are Euclidean over (combined, customer, supplier); a missing centroid is
    skipped and ties go to the lowest cluster.  Each value becomes
    round((value + centroid) / 2).
    """
    d = {}
    for k in (1, 2, 3):
        d[k] = F.sqrt(F.pow(comb0 - F.col(f"k{k}_comb"), 2) + F.pow(cust - F.col(f"k{k}_cust"), 2)
                      + F.pow(sup - F.col(f"k{k}_sup"), 2))
    cand = F.array(*[F.struct(d[k].alias("d"), F.lit(k).alias("k")) for k in (1, 2, 3)])
    best = F.array_min(F.filter(cand, lambda s: s["d"].isNotNull()))["k"]

    def pick(name):
        return (F.when(best == 1, F.col(f"k1_{name}")).when(best == 2, F.col(f"k2_{name}"))
                .when(best == 3, F.col(f"k3_{name}")))

    return {"distance1": d[1], "distance2": d[2], "distance3": d[3], "cluster": best,
            "i_comb": F.bround((comb0 + pick("comb")) / 2, 0),
            "i_cust": F.bround((cust + pick("cust")) / 2, 0),
            "i_sup": F.bround((sup + pick("sup")) / 2, 0)}


def value_histogram(values: DataFrame, val: str, n: str) -> DataFrame:
    """Entities for each score value; scores are whole numbers on a fixed scale, so this is a short table."""
    return values.groupBy(F.col("val").alias(val)).agg(F.count(F.lit(1)).alias(n))


class CrossInputs:
    """Shared pieces of the virtual product for one run."""

    def __init__(self, customers: DataFrame, suppliers: DataFrame, cust_scores: DataFrame, sup_scores: DataFrame,
                 pair_scores: DataFrame, p: Params = DEFAULT):
        self.stats = global_score_stats(cust_scores, sup_scores, pair_scores)
        st = self.stats
        self.hist_pairs = history(pair_scores, cust_scores, sup_scores)
        self.cents = centroids(self.hist_pairs)
        one = st.crossJoin(self.cents)
        self.one = one
        c_vals = customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct() \
            .join(cust_scores.select("customer_id", "score"), "customer_id", "left").crossJoin(F.broadcast(one))
        self.cust = c_vals.select("customer_id", "score", F.coalesce(
            F.col("score"), F.bround(F.col("customer_mean") + p.c("c3") * F.col("customer_std"), 0)).alias("val"))
        s_vals = suppliers.select("supplier_id").filter(F.col("supplier_id").isNotNull()).distinct() \
            .join(sup_scores.select("supplier_id", "score"), "supplier_id", "left").crossJoin(F.broadcast(one))
        self.sup = s_vals.select("supplier_id", "score", F.coalesce(
            F.col("score"), F.bround(F.col("supplier_mean") + p.c("c4") * F.col("supplier_std"), 0)).alias("val"))
        self.comb0 = F.bround(F.col("combine_mean") + p.c("c5") * F.col("combine_std"), 0)

    def value_table(self) -> DataFrame:
        """The imputed triple for each (customer value, supplier value), with the entities that hold them.

        Distinct values only: its size follows the score scale (at most about 800 x 800), not the entities.
        """
        values = (value_histogram(self.cust, "c_val", "n_c").crossJoin(value_histogram(self.sup, "s_val", "n_s"))
                  .crossJoin(F.broadcast(self.one)))
        cols = impute(self.comb0, F.col("c_val"), F.col("s_val"))
        table = values.select("c_val", "s_val", "n_c", "n_s", *[v.alias(k) for k, v in cols.items()])
        comb = F.when(F.col("i_comb") == 0, F.lit(50.0)).otherwise(F.col("i_comb"))
        return table.withColumn("combined_score", comb).withColumn("combined_level", level_of(comb))

    def _side(self, entity: str) -> tuple[DataFrame, str, str, str, str]:
        """Entities of a side, their key, their value column, the other side's, and its count, in the value table."""
        return ((self.sup, "supplier_id", "s_val", "c_val", "n_c") if entity == "supplier"
                else (self.cust, "customer_id", "c_val", "s_val", "n_s"))

    def imputation(self, entity: str) -> DataFrame:
        """Imputed triple for each entity of one side against every score value of the other side (an expansion for reports;
        no other step uses it)."""
        base, key, own, other, n = self._side(entity)
        table = self.value_table()
        j = base.select(key, "val").join(table, F.col("val").eqNullSafe(F.col(own)))
        return j.select(key, F.col(own).alias("s_val"), F.col(other).alias("o_val"), F.col(n).alias("n"), "distance1", "distance2",
                        "distance3", "cluster", "i_comb", "i_cust", "i_sup")

    def name_means(self, entity: str) -> DataFrame:
        """Mean score of each entity over the whole (virtual) product row set.

        History pairs contribute the entity's own score, the other pairs their
        imputed value: sum over all values of the other side (once for each own value), minus the history
        pairs' imputed values, plus the history pairs' own values.
        """
        base, key, own_val, _, n = self._side(entity)
        own, i_col = ("sup", "i_sup") if entity == "supplier" else ("cust", "i_cust")
        sums = self.value_table().groupBy(F.col(own_val).alias("__val")).agg(
            F.sum(F.col(n) * F.col(i_col)).alias("all_imputed"), F.sum(n).alias("others"))
        # history pairs: imputed value they would have had, and their own value
        h = self.hist_pairs.join(self.cust.select("customer_id", F.col("val").alias("cv")), "customer_id", "left") \
            .join(self.sup.select("supplier_id", F.col("val").alias("sv")), "supplier_id", "left") \
            .crossJoin(F.broadcast(self.one))
        hc = impute(self.comb0, F.col("cv"), F.col("sv"))
        hist_sum = h.groupBy(key).agg(F.sum(hc[i_col]).alias("hist_imputed"), F.sum(F.col(own)).alias("hist_own"),
                                      F.count(F.lit(1)).alias("n_history"))
        j = base.join(sums, F.col("val").eqNullSafe(F.col("__val")), "left").join(hist_sum, key, "left")
        total = (F.coalesce(F.col("all_imputed"), F.lit(0)) - F.coalesce(F.col("hist_imputed"), F.lit(0))
                 + F.coalesce(F.col("hist_own"), F.lit(0)))
        return j.select(key, "score", F.coalesce(F.col("n_history"), F.lit(0)).alias("n_history"),
                        (total / F.col("others")).alias("mean_score"))

    def lookup_pairs(self, requests: DataFrame) -> DataFrame:
        """Combined score and level of requested (customer_id, supplier_id) pairs, with or without history.

        A pair without history takes the value table's row for the two entities' values; a pair with an unknown
        entity has no score.  Nulls ids have no score either.
        """
        hist = self.hist_pairs.select("customer_id", "supplier_id", "combined")
        known = F.when(F.col("combined") == 0, F.lit(50.0)).otherwise(F.col("combined"))
        j = (requests.select("customer_id", "supplier_id").join(hist, ["customer_id", "supplier_id"], "left")
             .join(self.cust.select("customer_id", F.col("val").alias("c_val")), "customer_id", "left")
             .join(self.sup.select("supplier_id", F.col("val").alias("s_val")), "supplier_id", "left")
             .join(self.value_table().select("c_val", "s_val", "combined_score", "combined_level"), ["c_val", "s_val"], "left"))
        return j.select("customer_id", "supplier_id", F.col("combined").isNotNull().alias("has_history"),
                        F.coalesce(known, F.col("combined_score")).alias("combined_score"),
                        F.coalesce(level_of(known), F.col("combined_level")).alias("combined_level"))

    def finished_pairs(self, cust_final: DataFrame, sup_final: DataFrame) -> DataFrame:
        """History pairs of the product with levels (combined 0 -> 50)."""
        comb = F.when(F.col("combined") == 0, F.lit(50.0)).otherwise(F.col("combined"))
        return (self.hist_pairs.select("customer_id", "supplier_id", comb.alias("combined_score"))
                .withColumn("combined_level", level_of(F.col("combined_score")))
                .join(cust_final.select("customer_id", "customer_score", "customer_level"), "customer_id", "left")
                .join(sup_final.select("supplier_id", "supplier_score", "supplier_level"), "supplier_id", "left"))


def entity_final(means: DataFrame, key: str, prefix: str) -> DataFrame:
    """Per-name mean score with its level (the product-wide value before the update from the aggregates)."""
    return means.select(key, F.col("mean_score").alias(f"{prefix}_score"),
                        level_of(F.col("mean_score")).alias(f"{prefix}_level"))


def update_from_join(final: DataFrame, agg_scores: DataFrame, key: str, prefix: str) -> DataFrame:
    """Set-based ``UPDATE .. FROM``: where the aggregate table knows the entity, take its score and level."""
    a = agg_scores.select(key, F.col("score").alias("__s"), F.col("level").alias("__l"))
    j = final.join(a, key, "left")
    return j.select(key, F.coalesce(F.col("__s"), F.col(f"{prefix}_score")).alias(f"{prefix}_score"),
                    F.when(F.col("__s").isNotNull(), F.col("__l")).otherwise(F.col(f"{prefix}_level"))
                    .cast("int").alias(f"{prefix}_level"))


def override_nonhistorical(final: DataFrame, latest: DataFrame, agg_scores: DataFrame, key: str, prefix: str
                           ) -> DataFrame:
    """Overrides for entities without history: score = level minimum + 50, level = new level."""
    ov = latest.join(agg_scores.select(key), key, "left_anti").select(key, "new_level")
    j = final.join(ov, key, "left")
    has = F.col("new_level").isNotNull()
    return j.select(key,
                    F.when(has, (level_min(F.col("new_level")) + 50).cast("double"))
                    .otherwise(F.col(f"{prefix}_score")).alias(f"{prefix}_score"),
                    F.when(has, F.col("new_level")).otherwise(F.col(f"{prefix}_level")).cast("int")
                    .alias(f"{prefix}_level"))
