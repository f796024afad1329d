"""Normalisation of metrics within a group: z-score, zero mask, offset min-max.

Statistics come from one ``grouped`` aggregate joined back on the
group key once; in the aggregate and in the join a hot group is not one task's (``grouped``, ``_attach``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import sdiv
from ..params import DEFAULT


def std(x: Column) -> Column:
    """Sample std; exactly zero variance (max = min) is treated as no std."""
    return F.when(F.max(x) != F.min(x), F.stddev_samp(x))


#: a group with more than this share of the rows is hot; so there are at most 1 / HOT_SHARE hot groups
HOT_SHARE = 1 / 500
COUNT = "__n_rows"


#: share of the rows above which ``grouped`` combines a group's rows before it shuffles them
COMBINED_SHARE = HOT_SHARE


def dealt(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of all but the largest groups, dealt by group as they are, and the rows of the largest groups, as they lie.

    What groups the first by the keys (or by more columns) needs no shuffle of its own.  The largest groups have over ``COMBINED_SHARE`` of the rows each, so there
    are at most ``1 / COMBINED_SHARE``; their rows are for aggregates that combine before they shuffle, so that none is one task's.
    The number of tasks is the session's number of shuffle partitions: few bytes of rows become many of statistics, which adaptive execution, going by
    the rows, would put into too few tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    limit = counts.agg((F.sum("__n") * COMBINED_SHARE).alias("__limit"))
    large = F.broadcast(counts.crossJoin(F.broadcast(limit)).filter("__n > __limit").select(*keys))
    few = df.join(large, list(keys), "left_anti").select(*df.columns).repartition(tasks, *keys)
    return few, df.join(large, list(keys), "left_semi").select(*df.columns)


def grouped(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggs)`` for many aggregates over many small groups.

    Statistics of all metrics take kilobytes a group, far more than its few rows.  Combined before the shuffle, every task would hold (and spill) and
    send them for nearly each of its rows.  So the rows are dealt by group (``dealt``), and each group's statistics exist once, where its rows
    are.  Only the rows of the largest groups are combined first.
    """
    few, many = dealt(df, keys)
    return few.groupBy(*keys).agg(*aggs).unionByName(many.groupBy(*keys).agg(*aggs))


def _attach(df: DataFrame, keys: Sequence[str], stats: DataFrame) -> DataFrame:
    """``df`` with its group's row of ``stats`` (which counts the group's rows in ``COUNT``).

    One customer or supplier may hold a third of all rows.  Hot groups, of which there are at most ``1 / HOT_SHARE`` whatever the data, are told to every
    task with their number of shares; their rows are dealt to that many by a hash of the row, and their statistics are there once for each.
    So no task of the join gets more than about ``HOT_SHARE`` of the rows, without a second pass over them.
    """
    if not keys:
        return df.crossJoin(F.broadcast(stats))
    total = stats.agg(F.sum(COUNT).alias("__total"))
    shares = F.ceil(F.col(COUNT) / (F.col("__total") * HOT_SHARE)).cast("int")
    dealt = stats.crossJoin(F.broadcast(total)).withColumn("__shares", F.when(F.col("__total") > 0, shares).otherwise(1)).drop("__total", COUNT)
    hot = dealt.filter(F.col("__shares") > 1).select(*keys, "__shares")
    share = F.when(F.col("__shares") > 1, F.pmod(F.xxhash64(*df.columns), F.col("__shares")).cast("int")).otherwise(0)
    rows = df.join(F.broadcast(hot), list(keys), "left").withColumn("__share", share).drop("__shares")
    copies = dealt.withColumn("__share", F.explode(F.sequence(F.lit(0), F.col("__shares") - 1))).drop("__shares")
    return rows.join(copies, [*keys, "__share"], "left").drop("__share")


def _z(x: Column, m: str) -> Column:
    """``(x - mean) / std`` of metric ``m``; undefined (one row, zero variance, null) -> 0."""
    return F.coalesce(sdiv(x - F.col(f"__mu_{m}"), F.col(f"__sd_{m}")), F.lit(0.0))


def zscore(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], *, prefix: str = "z_") -> DataFrame:
    """Z-score of each metric within the group."""
    aggs = [a for m in metrics for a in (F.avg(m).alias(f"__mu_{m}"), std(F.col(m)).alias(f"__sd_{m}"))]
    aggs.append(F.count(F.lit(1)).alias(COUNT))
    stats = grouped(df, keys, aggs) if keys else df.agg(*aggs)
    return _attach(df, keys, stats).select(*df.columns, *[_z(F.col(m), m).alias(prefix + m) for m in metrics])


def masked_minmax(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], *,
                  constant: float = DEFAULT.min_max_constant, prefix: str = "n_",
                  zero_variance_to_zero: bool = False, extra: Sequence[Column] = ()) -> DataFrame:
    """Zero-masked, offset min-max of the group z-scores.

    ``z`` is forced to 0 where the raw value is 0, then
    ``n = ((z - min z) + c) / ((max z - min z) + c)`` over the group, and again
    ``n = 0`` where the raw value is 0.  A constant non-zero column gets 1, or 0
    when ``zero_variance_to_zero`` (the supplier-level variant, whose undefined
    z-scores stay missing until after the scaling).

    ``z`` grows with the raw value, so the masked extremes are those of the smallest and largest non-zero
    values, and 0 if the group has a zero or missing value: one aggregate gives all of it.  ``extra``
    are further group aggregates (with aliases) that come along with the same join.
    """
    aggs = []
    for m in metrics:
        x = F.col(m)
        some = F.when(x != 0, x)
        aggs += [F.avg(x).alias(f"__mu_{m}"), std(x).alias(f"__sd_{m}"), F.min(some).alias(f"__lx_{m}"), F.max(some).alias(f"__hx_{m}"),
                 F.max(F.when(x != 0, 0).otherwise(1)).alias(f"__zero_{m}")]
    stats = grouped(df, keys, [*aggs, *extra, F.count(F.lit(1)).alias(COUNT)])
    masked = {}
    for m in metrics:
        zero = F.when(F.col(f"__zero_{m}") == 1, F.lit(0.0))
        masked[f"__lo_{m}"] = F.least(F.when(F.col(f"__lx_{m}").isNotNull(), _z(F.col(f"__lx_{m}"), m)), zero)
        masked[f"__hi_{m}"] = F.greatest(F.when(F.col(f"__hx_{m}").isNotNull(), _z(F.col(f"__hx_{m}"), m)), zero)
    stats = stats.withColumns(masked).drop(*[f"__{x}_{m}" for m in metrics for x in ("lx", "hx", "zero")])
    named = [c for c in stats.columns if not c.startswith("__") and c not in keys]
    out = _attach(df, keys, stats)
    cols = []
    for m in metrics:
        zm, lo, hi = _z(F.col(m), m), F.col(f"__lo_{m}"), F.col(f"__hi_{m}")
        n = ((zm - lo) + constant) / ((hi - lo) + constant)
        if zero_variance_to_zero:
            n = F.when(F.col(f"__sd_{m}").isNull(), F.lit(0.0)).otherwise(n)
        cols.append(F.when(F.col(m) == 0, F.lit(0.0)).otherwise(n).alias(prefix + m))
    return out.select(*df.columns, *named, *cols)


def rowwise_z(df: DataFrame, name: str, metrics: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """z-score of each metric against the row's own metrics (population std); undefined -> null.

    Mean and std become helper columns first, so that no expression repeats them.
    """
    def total(terms: list[Column]) -> Column:
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    mean, dev = F.col(f"__rm_{name}"), F.col(f"__rs_{name}")
    df = df.withColumn(f"__rm_{name}", total([F.col(m) for m in metrics]) / len(metrics))
    df = df.withColumn(f"__rs_{name}", F.sqrt(total([(F.col(m) - mean) * (F.col(m) - mean) for m in metrics]) / len(metrics)))
    return df, {m: sdiv(F.col(m) - mean, dev) for m in metrics}
