"""Supplier exposure, supplier weights (first principal component), supplier scores.

Skew: a single supplier may trade with most customers, so nothing here uses a
window keyed by supplier.  Per-supplier statistics come from partially
aggregated ``groupBy``s joined back on ``supplier_id``; AQE turns that join into
a broadcast when the statistics are small at run time and splits skewed
partitions otherwise.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clamp, from_units, level_of, units
from ..params import (AGG_SCALE, DEFAULT, SUPPLIER_METRICS, SUPPLIER_NEGATIVE, SUPPLIER_PAIR_SCALE,
                      SUPPLIER_POSITIVE, Params)
from . import normalize
from .clean import scan_window
from .score import linear, weighted_sum

EXPOSURE = ("open_payable", "open_credit_memo", "other_open_payables", "cash_balance", "unapplied_amount")


def supplier_id_by_name(crm_classes: DataFrame) -> DataFrame:
    """Supplier name -> one id (the smallest), so a duplicated name cannot multiply rows."""
    return (crm_classes.filter(F.col("supplier").isNotNull())
            .groupBy("supplier").agg(F.min("supplier_id").alias("supplier_id")))


def payables_by_supplier(open_payable: DataFrame, unapplied_balance: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Open payables and unapplied balances of the window, summed per supplier id."""
    op = (scan_window(open_payable, "invoice_date", p).filter(F.col("id").isNotNull())
          .groupBy(F.col("id").alias("supplier_id")).agg(F.sum(units("open_payable")).alias("open_payable_u")))
    ub = (scan_window(unapplied_balance, "invoice_date", p).filter(F.col("id").isNotNull())
          .groupBy(F.col("id").alias("supplier_id")).agg(F.sum(units("unapplied_amount")).alias("unapplied_u")))
    return op.join(ub, "supplier_id", "full")


def other_payables_by_supplier(other_open_payables: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Other open payables of the window summed per supplier (numeric column only)."""
    return (scan_window(other_open_payables, "bill_date", p).filter(F.col("client_id").isNotNull())
            .groupBy(F.col("client_id").alias("supplier_id"))
            .agg(F.sum(units("other_open_payables")).alias("other_open_payables_u")))


def credit_memo_by_supplier(credit_memo: DataFrame, crm_classes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Open credit memos of the window, matched to a supplier by name, summed per supplier."""
    cm = scan_window(credit_memo, "creditmemo_date", p)
    return (cm.join(supplier_id_by_name(crm_classes), "supplier", "left")
            .filter(F.col("supplier_id").isNotNull())
            .groupBy("supplier_id").agg(F.sum(units("amount")).alias("open_credit_memo_u")))


def cash_by_supplier(cash_balance: DataFrame) -> DataFrame:
    """Current cash balance per supplier (zero balances dropped)."""
    cb = cash_balance.filter((F.col("cash_balance") != 0) | F.col("cash_balance").isNull())
    return (cb.filter(F.col("id").isNotNull()).groupBy(F.col("id").alias("supplier_id"))
            .agg(F.sum(units("cash_balance")).alias("cash_balance_u")))


def supplier_dimension(t, p: Params = DEFAULT) -> DataFrame:
    """The five exposure amounts per supplier, built once (full outer joins on supplier_id)."""
    parts = [payables_by_supplier(t.open_payable, t.unapplied_balance, p),
             credit_memo_by_supplier(t.credit_memo, t.crm_classes, p),
             other_payables_by_supplier(t.other_open_payables, p),
             cash_by_supplier(t.cash_balance)]
    dim = parts[0]
    for part in parts[1:]:
        dim = dim.join(part, "supplier_id", "full")
    return dim.select(
        "supplier_id",
        *[F.coalesce(F.col(f"{c}_u"), F.lit(0)).alias(f"{c}_u") for c in
          ("open_payable", "open_credit_memo", "other_open_payables", "cash_balance")],
        F.coalesce(F.col("unapplied_u"), F.lit(0)).alias("unapplied_amount_u"))


def with_exposure(df: DataFrame, dim: DataFrame, open_ar: str = "open_ar") -> DataFrame:
    """Attach exposure amounts, wallet and supplier risk balance (missing exposure = 0)."""
    j = df.join(dim, "supplier_id", "left")
    u = {c: F.coalesce(F.col(f"{c}_u"), F.lit(0)) for c in EXPOSURE}
    wallet = u["unapplied_amount"] - u["other_open_payables"] - u["open_credit_memo"]
    risk = units(open_ar) - u["other_open_payables"] - u["open_credit_memo"] + u["cash_balance"]
    return j.select(*df.columns, *[from_units(u[c]).alias(c) for c in EXPOSURE],
                    from_units(wallet).alias("wallet"), from_units(risk).alias("risk_balance_s"))


def supplier_pairs(pair_frame: DataFrame, dim: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pair grain supplier frame: pair metrics, customer score and exposure.

    ``pair_frame`` needs customer_id, supplier_id, supplier_name, total_invoice,
    open_ar, total_ar, outstanding_balance, predict_ar_10d, predict_ar_30d, score.
    """
    df = pair_frame
    if p.excluded_supplier is not None:
        df = df.filter((F.col("supplier_name") != p.excluded_supplier) | F.col("supplier_name").isNull())
    df = df.withColumnRenamed("score", "customer_score")
    return with_exposure(df, dim).withColumnRenamed("risk_balance_s", "risk_balance")


def supplier_rollup(pair_frame: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per supplier: sums of balances and predictions, mean pair score."""
    df = pair_frame
    if p.excluded_supplier is not None:
        df = df.filter((F.col("supplier_name") != p.excluded_supplier) | F.col("supplier_name").isNull())
    sums = ["total_invoice", "open_ar", "total_ar", "outstanding_balance", "predict_ar_10d", "predict_ar_30d"]
    return df.groupBy("supplier_id").agg(
        *[from_units(F.sum(units(c))).alias(c) for c in sums],
        F.avg("score").alias("customer_score"))


def supplier_totals(rollup: DataFrame, dim: DataFrame) -> DataFrame:
    """Supplier grain frame: roll-up plus exposure, wallet and risk balance."""
    return with_exposure(rollup, dim).withColumnRenamed("risk_balance_s", "risk_balance")


def pca_weights(totals: DataFrame, metrics: Sequence[str] = SUPPLIER_METRICS) -> dict[str, float]:
    """First principal component loadings of the z-scored supplier metrics, sign-forced.

    The z-scoring is a DataFrame aggregation; the covariance is accumulated
    distributedly by ``pyspark.ml.feature.PCA`` and only the 10 x 10 matrix is
    decomposed on the driver.  The component's sign is fixed so its largest
    absolute loading is positive, then the sign rules apply.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    z = normalize.zscore(totals.select(*metrics), metrics, [], prefix="z_")
    vec = VectorAssembler(inputCols=["z_" + m for m in metrics], outputCol="v").transform(z).select("v")
    model = PCA(k=1, inputCol="v", outputCol="pc").fit(vec)
    loadings = [float(x) for x in model.pc.toArray()[:, 0]]
    big = max(range(len(loadings)), key=lambda i: abs(loadings[i]))
    if loadings[big] < 0:
        loadings = [-x for x in loadings]
    out = {}
    for m, w in zip(metrics, loadings):
        out[m] = abs(w) if m in SUPPLIER_POSITIVE else -abs(w) if m in SUPPLIER_NEGATIVE else w
    return out


def weights_frame(spark, weights: dict[str, float], metrics: Sequence[str] = SUPPLIER_METRICS) -> DataFrame:
    """One-row DataFrame ``w_<metric>``."""
    return spark.createDataFrame([tuple(float(weights[m]) for m in metrics)], ["w_" + m for m in metrics])


def supplier_weights(totals: DataFrame, weights_row: DataFrame) -> DataFrame:
    """Every supplier id with the (global) supplier weights attached."""
    return totals.select("supplier_id").distinct().crossJoin(F.broadcast(weights_row))


def supplier_normalised(sp: DataFrame, metrics: Sequence[str] = SUPPLIER_METRICS) -> DataFrame:
    """Normalise the pair grain supplier frame within each supplier (``n_<metric>``).

    Several customers: z-score, zero mask, offset min-max; a constant column gives 0.
    One customer: positive and negative metric sets z-scored within the row
    (population std), zero-masked and made absolute; the other metrics are 0.
    """
    mm = normalize.masked_minmax(sp, metrics, ["supplier_id"], zero_variance_to_zero=True,
                                 extra=[F.count(F.lit(1)).alias("n_customers")])
    single = F.col("n_customers") == 1
    cols, rowwise, names = {}, {}, mm.columns
    for name, group in (("positive", SUPPLIER_POSITIVE), ("negative", SUPPLIER_NEGATIVE)):
        mm, z = normalize.rowwise_z(mm, name, group)
        for m in group:
            rowwise[m] = F.coalesce(F.abs(F.when(F.col(m) == 0, F.lit(0.0)).otherwise(z[m])), F.lit(0.0))
    for m in metrics:
        cols["n_" + m] = F.when(single, rowwise.get(m, F.lit(0.0))).otherwise(F.coalesce(F.col("n_" + m), F.lit(0.0)))
    return mm.withColumns(cols).select(*names)


def supplier_pair_scores(sp: DataFrame, weights_row: DataFrame, metrics: Sequence[str] = SUPPLIER_METRICS) -> DataFrame:
    """Pair grain supplier score: ``(sum + 3) * 133.33``, half-even round, clamp, level."""
    normed = supplier_normalised(sp, metrics).crossJoin(F.broadcast(weights_row))
    raw = linear(weighted_sum(metrics), SUPPLIER_PAIR_SCALE)
    out = normed.withColumn("score_raw", raw).withColumn("score", clamp(F.bround(F.col("score_raw"), 0)))
    return out.withColumn("level", level_of(F.col("score")))


def risk_factors(totals: DataFrame, weights_row: DataFrame,
                 metrics: Sequence[str] = SUPPLIER_METRICS) -> DataFrame:
    """Text naming the metrics that weigh most against a supplier.

    For ``v = metric * weight`` (risk balance and customer score excluded): the
    two largest ``|v|`` among ``v <= 0`` followed by the smallest ``|v|`` among
    ``v > 0``; ties keep metric order.
    """
    used = [m for m in metrics if m not in ("risk_balance", "customer_score")]
    j = totals.crossJoin(F.broadcast(weights_row))
    items = F.array(*[F.struct((F.col(m) * F.col("w_" + m)).alias("v"), F.lit(i).alias("i"), F.lit(m).alias("name"))
                      for i, m in enumerate(used)])
    neg = F.filter(items, lambda s: s["v"] <= 0)
    pos = F.filter(items, lambda s: s["v"] > 0)
    def ranked(arr, key):
        keyed = F.transform(arr, lambda s: F.struct(key(s).alias("k"), s["i"].alias("i"), s["name"].alias("name")))
        return F.transform(F.array_sort(keyed), lambda s: s["name"])

    neg_sorted = ranked(neg, lambda s: -F.abs(s["v"]))
    pos_sorted = ranked(pos, lambda s: F.abs(s["v"]))
    names = F.concat(F.slice(neg_sorted, 1, 2), F.slice(pos_sorted, 1, 1))
    return j.select("supplier_id", F.array_join(names, ", ").alias("risk_factor"))


def modal_level(scored: DataFrame, key: str, level: str = "level") -> DataFrame:
    """Most frequent level per entity; ties go to the lowest level."""
    counts = scored.filter(F.col(level).isNotNull()).groupBy(key, level).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(
        F.max_by(F.col(level), F.struct(F.col("n"), -F.col(level))).alias("modal_level"))


def entity_attributes(rows: DataFrame, key: str, attrs) -> DataFrame:
    """One value of each attribute per entity (the largest), from the distinct combinations.

    Strings would turn a whole aggregate into a sort; grouping them first is a hash aggregate, and the sort sees about
    one row per entity.
    """
    return rows.select(key, *attrs).distinct().groupBy(key).agg(*[F.max(a).alias(a) for a in attrs])


def agg_supplier_metrics(scored_sp: DataFrame) -> DataFrame:
    """Supplier aggregate of the scored pair grain supplier frame."""
    sums = ["total_invoice", "open_ar", "predict_ar_10d", "predict_ar_30d", "total_ar", "outstanding_balance"]
    firsts = ["unapplied_amount", "open_payable", "open_credit_memo", "other_open_payables", "cash_balance", "wallet"]
    agg = scored_sp.groupBy("supplier_id").agg(
        *[from_units(F.sum(units(c))).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in firsts],
        F.avg("customer_score").alias("customer_score"))
    agg = agg.join(entity_attributes(scored_sp, "supplier_id", ["supplier_name"]), "supplier_id", "left")
    risk = units("open_ar") - units("other_open_payables") - units("open_credit_memo") + units("cash_balance")
    return agg.withColumn("risk_balance", from_units(risk))


def agg_supplier_score(agg: DataFrame, modal: DataFrame, weights_row: DataFrame,
                       metrics: Sequence[str] = SUPPLIER_METRICS) -> DataFrame:
    """Supplier score within its modal-level bucket.

    Three buckets only, so the bucket statistics are a 3-row grouped aggregate
    joined back (never a 3-partition window).
    """
    df = agg.join(modal, "supplier_id", "left")
    normed = normalize.masked_minmax(df, metrics, ["modal_level"])
    raw = linear(weighted_sum(metrics), AGG_SCALE)
    out = (normed.crossJoin(F.broadcast(weights_row))
           .withColumn("score_raw", F.when(F.col("modal_level").isNotNull(), raw))
           .withColumn("score", F.coalesce(clamp(F.bround(F.col("score_raw"), 0)), F.lit(0.0))))
    return out.withColumn("level", level_of(F.col("score")))


def contract_status_by_supplier(contract_status: DataFrame) -> DataFrame:
    """One contract status row per supplier (lowest status index)."""
    return (contract_status.filter(F.col("id").isNotNull())
            .groupBy(F.col("id").alias("supplier_id"))
            .agg(F.min_by(F.struct("status_short", "display_name", "status_index"),
                          F.struct(F.coalesce(F.col("status_index"), F.lit(1 << 30)), F.col("status_short"))).alias("s"))
            .select("supplier_id", "s.status_short", "s.display_name", "s.status_index"))


def pair_detail(scored: DataFrame, dim: DataFrame, contract_status: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The published detail of each scored pair: its metrics and predictions (``columns``), the customer's risk balance, the supplier's exposure, wallet
    and risk balance (on all receivables), and its contract status."""
    rows = with_exposure(scored.select(*columns), dim, open_ar="total_ar")
    return (rows.withColumnsRenamed({"risk_balance": "customer_risk_balance", "risk_balance_s": "supplier_risk_balance"})
            .join(contract_status_by_supplier(contract_status), "supplier_id", "left"))
