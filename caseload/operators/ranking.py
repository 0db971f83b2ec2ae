"""Global rank statistics without a single-task global window.

``value_prefix`` returns, for every distinct value, the summed weights at that value and the
cumulative weights of all strictly smaller values. It range-buckets the distinct values with
approximate quantile bounds of the rows (one-row aggregate, broadcast), computes per-bucket totals (at most
``n_buckets`` rows, so their running offsets are a tiny window), and finishes with a window
partitioned by bucket. The result is exact; only the bucket boundaries are approximate. There are as
many buckets as shuffle partitions, and a value's bucket is found by halving. Bounds and totals are partial sums of a scan;
only the last scan shuffles, each distinct value twice.
AUC, average precision, Spearman and ROC points are sums over this table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.operators.joins import join_cells, null_safe_join
from caseload.session import scratch_table


def value_prefix(df: DataFrame, value: str, weights: dict[str, Column], *, by: list[str] | None = None,
                 n_buckets: int | None = None) -> DataFrame:
    by = bb = list(by or [])
    n_buckets = max(2, n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.where(F.col(value).isNotNull())
    qs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = rows.groupBy(*bb).agg(F.percentile_approx(value, qs, max(10000, 10 * n_buckets)).alias("_bounds"))
    d = (null_safe_join(rows, bounds, bb, "left", broadcast_right=True) if bb else rows.crossJoin(F.broadcast(bounds)))
    d = d.withColumn("_bucket", F.lit(0))
    for step in (1 << i for i in reversed(range(len(qs).bit_length()))):  # how many bounds are below the value
        at = F.col("_bucket")
        d = d.withColumn("_bucket", F.when(F.get("_bounds", at + (step - 1)) < F.col(value), at + step).otherwise(at))
    tot = d.groupBy(*by, "_bucket").agg(*[F.sum(w).alias(n) for n, w in weights.items()])
    wo = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1) if by else \
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*by, "_bucket", *[F.coalesce(F.sum(n).over(wo), F.lit(0)).alias(f"_off_{n}") for n in weights])
    d = d.groupBy(*by, "_bucket", value).agg(*[F.sum(w).alias(n) for n, w in weights.items()])
    d = null_safe_join(d, offs, [*by, "_bucket"], "inner", broadcast_right=True)
    wb = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return d.select(*by, value, *weights,
                    *[(F.coalesce(F.sum(n).over(wb), F.lit(0)) + F.col(f"_off_{n}")).alias(f"{n}_below")
                      for n in weights])


CELL_BUCKETS = 32_768  # buckets of all cells together, if every cell may have 48 or more


def cell_medians(df: DataFrame, cells: list[str], columns: list[str], buckets: int | None = None, also: dict[str, Column] | None = None) -> DataFrame:
    """Exact medians of ``columns`` in every cell (one row per cell, NULL cells included), no cell in one task.
    ``also``: aggregates of the cells by name, taken in the same scan as the means.

    A median lies within one standard deviation of the mean, so that stretch is cut into ``buckets`` (by default fewer, the
    more cells there are). One scan counts the buckets, which tells which one or two hold the middle ranks; another shuffles and orders
    only the values inside these. Any bounds would give the exact median, as counts decide. What grows with
    the cells is written between the scans, what grows with the rows is not."""
    also = also or {}
    typed = df.select("*", *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    grid = scratch_table(typed.groupBy(*cells).agg(*[f(f"_v{i}").alias(f"_{n}{i}") for i in range(len(columns)) for n, f in (("mean", F.avg), ("sd", F.stddev_pop))],
                                                   *[a.alias(n) for n, a in also.items()]))
    half = max(2, (buckets or max(48, min(1024, CELL_BUCKETS // max(1, grid.count())))) // 2)

    def bucket(i: int) -> Column:  # never falls as the value rises
        at = (F.col(f"_v{i}") - F.col(f"_mean{i}")) / F.col(f"_sd{i}") * half
        return F.when(F.col(f"_sd{i}") > 0, F.floor(F.greatest(F.lit(-half - 1.0), F.least(F.lit(float(half)), at)))).otherwise(F.lit(0)).cast("int")

    wide = join_cells(typed.select(*cells, *[f"_v{i}" for i in range(len(columns))]), grid.drop(*also), cells)
    long = wide.select(*cells, F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_v{i}").alias("v"), bucket(i).alias("bucket")) for i in range(len(columns))])).alias("x"))
    placed = long.select(*cells, "x.c", "x.v", "x.bucket").where(F.col("v").isNotNull())
    keys = [*cells, "c"]
    totals = placed.groupBy(*keys, "bucket").agg(F.count("*").alias("held"))
    order = Window.partitionBy(*keys)
    before = order.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = totals.select(*keys, "bucket", "held", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"), F.sum("held").over(order).alias("size"))
    low, high = F.floor((F.col("size") - 1) / 2), F.ceil((F.col("size") - 1) / 2)
    middle = scratch_table(ranks.select(*keys, "bucket", "held", "offset", low.alias("low"), high.alias("high")).where(
        (F.col("offset") <= F.col("high")) & (F.col("offset") + F.col("held") > F.col("low"))).drop("held"))
    counts = join_cells(placed, middle, [*keys, "bucket"], "inner").groupBy(*keys, "bucket", "offset", "low", "high", "v").agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("upto", F.col("offset") + F.sum("n").over(inside))
    holds = lambda rank: (F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("n"))
    found = upto.groupBy(*keys).agg(F.max(F.when(holds("low"), F.col("v"))).alias("a"), F.max(F.when(holds("high"), F.col("v"))).alias("b"))
    medians = found.groupBy(*cells).agg(*[F.max(F.when(F.col("c") == i, (F.col("a") + F.col("b")) / 2)).alias(f"median_{c}") for i, c in enumerate(columns)])
    return scratch_table(null_safe_join(grid.select(*cells, *also), medians, cells, "left"))


def auc_ap(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Exact ROC-AUC (ties half credit) and average precision (step sum over thresholds)."""
    by = list(by or [])
    y = F.col(label).cast("double")
    d = value_prefix(df, score, {"pos": y, "neg": F.lit(1.0) - y}, by=by)
    tot = df.where(F.col(score).isNotNull()).groupBy(*by).agg(F.sum(y).alias("_tot_pos"), F.sum(F.lit(1.0) - y).alias("_tot_neg"))
    d = null_safe_join(d, tot, by, "inner", broadcast_right=True) if by else d.crossJoin(F.broadcast(tot))
    P, N = F.col("_tot_pos"), F.col("_tot_neg")
    tp_ge = P - F.col("pos_below")
    c_ge = P + N - F.col("pos_below") - F.col("neg_below")
    return d.groupBy(*by).agg(
        F.when((F.max(P) > 0) & (F.max(N) > 0),
               F.sum(F.col("pos") * (F.col("neg_below") + F.lit(0.5) * F.col("neg")))
               / (F.max(P) * F.max(N))).alias("roc_auc"),
        F.when(F.max(P) > 0, F.sum((F.col("pos") / P) * (tp_ge / c_ge))).alias("average_precision"))


def average_rank(df: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Average rank (1-based, ties share the mean rank) attached to every row with a value."""
    by = list(by or [])
    d = value_prefix(df, value, {"_n": F.lit(1)}, by=by)
    d = d.select(*by, value, (F.col("_n_below") + (F.col("_n") + F.lit(1)) / F.lit(2.0)).alias(out))
    return null_safe_join(df, d, [*by, value], "left")


def spearman(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Spearman correlation = Pearson correlation of average ranks (rows with both values)."""
    by = list(by or [])
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, x, y)
    r = average_rank(average_rank(both, x, "_rx", by), y, "_ry", by)
    return r.groupBy(*by).agg(F.corr("_rx", "_ry").alias("spearman"))



def exact_percentiles(df: DataFrame, col: str, qs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (the ``percentile`` aggregate's definition),
    distributed: value counts and their prefix sums come from ``value_prefix``; the two ranks
    floor(h), ceil(h) with h = (n-1)q are located by a range condition against a tiny broadcast
    target table. No group's values are buffered in one task. One row per group (NULLs when a
    group has no values); one column per name in ``qs``."""
    by = list(by or [])
    wide = prefix_percentiles(value_prefix(df, col, {"_n": F.lit(1)}, by=by), col, qs, by)
    if by:
        return null_safe_join(df.select(*by).distinct(), wide, by, "left", broadcast_right=True).select(*by, *qs)
    return df.sparkSession.range(1).join(wide, F.lit(True), "left").select(*qs)


def prefix_percentiles(prefix: DataFrame, col: str, qs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """``exact_percentiles`` out of a ``value_prefix`` table with the weight ``_n`` (rows); groups without values have no row."""
    by = list(by or [])
    tot = prefix.groupBy(*by).agg(F.sum("_n").alias("_N"))
    tgt = tot.select(*[F.col(b).alias(f"_t_{b}") for b in by], F.explode(F.array(*[
        F.struct(F.lit(n).alias("_q"), ((F.col("_N") - 1) * F.lit(float(q))).alias("_h")) for n, q in qs.items()])).alias("_t")) \
        .select(*[f"_t_{b}" for b in by], "_t._q", "_t._h", F.floor("_t._h").alias("_lo"), F.ceil("_t._h").alias("_hi"))
    in_lo = (F.col("_n_below") <= F.col("_lo")) & (F.col("_lo") < F.col("_n_below") + F.col("_n"))
    in_hi = (F.col("_n_below") <= F.col("_hi")) & (F.col("_hi") < F.col("_n_below") + F.col("_n"))
    cond = in_lo | in_hi
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_t_{b}"))
    tk = [f"_t_{b}" for b in by]
    j = prefix.select(*by, col, "_n", "_n_below").join(F.broadcast(tgt), cond).select(
        *tk, "_q", "_h", "_lo", F.when(in_lo, F.col(col)).alias("_xl"), F.when(in_hi, F.col(col)).alias("_xh"))
    parts = j.groupBy(*tk, "_q", "_h", "_lo").agg(F.max("_xl").alias("_xlo"), F.max("_xh").alias("_xhi"))
    val = F.col("_xlo") + (F.col("_h") - F.col("_lo")) * (F.col("_xhi") - F.col("_xlo"))
    wide = parts.groupBy(*tk).agg(*[F.max(F.when(F.col("_q") == n, val)).alias(n) for n in qs])
    return wide.select(*[F.col(f"_t_{b}").alias(b) for b in by], *qs)
