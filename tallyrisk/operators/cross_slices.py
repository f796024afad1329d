"""The customer x supplier scores computed slice by slice of the customers.

The customers, ordered by id, are cut into ``n`` runs of equal length (bounds ``round(N * k / n)``, halves to even).  Each slice has centroids, imputed
values and entity means of its own; the score statistics are those of all entities.  With ``n = 1`` everything equals ``cross.CrossInputs``.

No slice is looped over: the slice is one more grouping key, so all slices are computed in one pass, and the value table has at most
``n`` times the distinct score values.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import level_of
from .cross import CrossInputs, centroid_columns, impute

_ROW_BITS = 33      # monotonically_increasing_id keeps the row within a partition in its lower 33 bits


def positions(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` (one row per key) with each key's place in the order of keys, from 0, as ``pos``.

    Range partitions are sorted, numbered within, and moved by the row counts of the partitions before them; only those counts, one row
    for each partition, meet in one task.  The numbered rows are checkpointed, as a second pass might draw other bounds.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(keys.sparkSession)
    rows = (keys.repartitionByRange(F.col(key)).sortWithinPartitions(key)
            .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    rows = rows.withColumn("_part", F.shiftright("_mid", _ROW_BITS))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    at = F.col("_before") + F.col("_mid") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return rows.join(F.broadcast(before), "_part").select(*keys.columns, at.alias("pos"))


def customer_slices(customers: DataFrame, n: int) -> DataFrame:
    """Each customer id with its slice, from 1."""
    ids = customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    placed = positions(ids, "customer_id")
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    bounds = [F.bround(F.col("_total") * k / n, 0) <= F.col("pos") for k in range(1, n)]
    number = F.lit(1)
    for reached in bounds:
        number = number + reached.cast("int")
    return placed.crossJoin(F.broadcast(total)).select("customer_id", number.alias("slice"))


class SlicedCross:
    """Centroids, imputed values and entity means for each slice of the customers."""

    def __init__(self, inputs: CrossInputs, slices: DataFrame):
        self.inputs, self.slices = inputs, slices
        numbers = slices.select("slice").distinct()
        hist = inputs.hist_pairs.join(slices, "customer_id")
        self.hist_pairs = hist
        #: a slice without history has no centroid and imputes nothing
        self.cents = numbers.join(hist.groupBy("slice").agg(*centroid_columns()), "slice", "left")
        self.cust = inputs.cust.join(slices, "customer_id")

    def value_table(self) -> DataFrame:
        """The imputed triple for each (slice, customer value, supplier value), with the entities that hold them."""
        c_vals = self.cust.groupBy("slice", F.col("val").alias("c_val")).agg(F.count(F.lit(1)).alias("n_c"))
        s_vals = self.inputs.sup.groupBy(F.col("val").alias("s_val")).agg(F.count(F.lit(1)).alias("n_s"))
        values = (c_vals.join(F.broadcast(self.cents), "slice").crossJoin(s_vals).crossJoin(F.broadcast(self.inputs.stats)))
        cols = impute(self.inputs.comb0, F.col("c_val"), F.col("s_val"))
        table = values.select("slice", "c_val", "s_val", "n_c", "n_s", *[v.alias(k) for k, v in cols.items()])
        comb = F.when(F.col("i_comb") == 0, F.lit(50.0)).otherwise(F.col("i_comb"))
        return table.withColumn("combined_score", comb).withColumn("combined_level", level_of(comb))

    def name_means(self, entity: str) -> DataFrame:
        """Mean score of each entity over the product rows of each slice it occurs in (a supplier in all, a customer in its own)."""
        table = self.value_table()
        if entity == "supplier":
            base = self.inputs.sup.crossJoin(F.broadcast(self.slices.select("slice").distinct()))
            key, own_val, n, own, i_col = "supplier_id", "s_val", "n_c", "sup", "i_sup"
        else:
            base, key, own_val, n, own, i_col = self.cust, "customer_id", "c_val", "n_s", "cust", "i_cust"
        sums = table.groupBy(F.col("slice").alias("_slice"), F.col(own_val).alias("_val")).agg(
            F.sum(F.col(n) * F.col(i_col)).alias("all_imputed"), F.sum(n).alias("others"))
        h = (self.hist_pairs.join(self.inputs.cust.select("customer_id", F.col("val").alias("cv")), "customer_id", "left")
             .join(self.inputs.sup.select("supplier_id", F.col("val").alias("sv")), "supplier_id", "left")
             .join(F.broadcast(self.cents), "slice").crossJoin(F.broadcast(self.inputs.stats)))
        imputed = impute(self.inputs.comb0, F.col("cv"), F.col("sv"))[i_col]
        hist = h.groupBy("slice", key).agg(F.sum(imputed).alias("hist_imputed"), F.sum(own).alias("hist_own"),
                                           F.count(F.lit(1)).alias("n_history"))
        j = (base.join(sums, (F.col("slice") == F.col("_slice")) & F.col("val").eqNullSafe(F.col("_val")), "left")
             .join(hist, ["slice", key], "left"))
        total = (F.coalesce("all_imputed", F.lit(0)) - F.coalesce("hist_imputed", F.lit(0)) + F.coalesce("hist_own", F.lit(0)))
        mean = total / F.col("others")
        return j.select("slice", key, F.coalesce("n_history", F.lit(0)).alias("n_history"), mean.alias("mean_score"),
                        level_of(mean).alias("level"))
