"""Lens 1: S2 deviation score over the scored panel.

Everything is column expressions in one projection per step, plus two small aggregates:
peer-cell medians (grouped aggregate + join, so partial aggregation and AQE apply; the NULL
cell is kept as its own group) and the one-row robust YoY scale (broadcast cross join of a
single row -- a proven size bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.config import DEFAULT_CALENDAR, S2_HISTORY_SIGNALS, S2Config, SplitCalendar
from caseload.functions.exprs import clip
from caseload.operators.joins import join_cells
from caseload.operators.ranking import cell_medians
from caseload.session import scratch_table
from caseload.sources.contracts import PEER_INPUT_COLUMNS, require_columns

STRATEGIES = ("channel", "company_division", "hybrid")
YOY = ("net_revenue_yoy_ratio", "order_count_yoy_ratio")


def masks(df: DataFrame, cal: SplitCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """Fit mask, forward window, eligibility (NULL sparse flag counts as sparse)."""
    sparse = F.coalesce(F.col("sparse_history_flag"), F.lit(True))
    m = F.col("transaction_month")
    return df.select(
        *df.columns,
        ((m <= F.lit(cal.train_end)) & ~sparse).alias("fit_mask"),
        m.between(F.lit(cal.forward_start), F.lit(cal.forward_end)).alias("forward"),
        (~sparse).alias("eligible"),
    )


def peer_residuals(df: DataFrame, group_col: str = "company_division_peer_public_id") -> DataFrame:
    """Value - exact median within (month, peer group), clipped +-10, plus non-null count."""
    keys = ["transaction_month", group_col]
    cells = cell_medians(df, keys, ["net_revenue_vs_history_z", "order_count_vs_history_z"],
                         also={"cd_group_count": F.count("net_revenue_vs_history_z")}).withColumnsRenamed(
        {"median_net_revenue_vs_history_z": "_med_spend", "median_order_count_vs_history_z": "_med_order"})
    j = join_cells(df, cells, keys)
    return j.select(
        *df.columns,
        clip(F.col("net_revenue_vs_history_z") - F.col("_med_spend"), -10, 10).alias("cd_spend_residual"),
        clip(F.col("order_count_vs_history_z") - F.col("_med_order"), -10, 10).alias("cd_order_residual"),
        F.coalesce(F.col("cd_group_count"), F.lit(0)).cast("bigint").alias("cd_group_count"),
    )


def fallbacks(df: DataFrame, min_peer_rows: int = 5) -> DataFrame:
    """Usability and the channel / company-division / hybrid fallbacks.

    ``when`` (not ``coalesce``): a NULL residual in a usable cell stays NULL.
    """
    sparse_peer = F.coalesce(F.col("sparse_peer_group_flag"), F.lit(True))
    cd_usable = ((F.col("cd_group_count") >= min_peer_rows)
                 & F.col("order_value_vs_company_division_peer_z").isNotNull()
                 & ~F.coalesce(F.col("sparse_company_division_peer_group_flag"), F.lit(True)))
    df = df.withColumn("cd_usable", cd_usable)
    u = F.col("cd_usable")
    ch_spend = F.when(~sparse_peer, F.col("net_revenue_vs_peers_resid")).otherwise(F.col("net_revenue_vs_history_z"))
    ch_order = F.when(~sparse_peer, F.col("order_count_vs_peers_resid")).otherwise(F.col("order_count_vs_history_z"))
    return df.select(
        *df.columns,
        ch_spend.alias("channel_spend"), ch_order.alias("channel_order"),
        F.col("net_revenue_vs_peer_z").alias("channel_peer_level"),
        sparse_peer.alias("channel_sparse"),
        F.when(u, F.col("cd_spend_residual")).otherwise(F.col("net_revenue_vs_history_z")).alias("company_division_spend"),
        F.when(u, F.col("cd_order_residual")).otherwise(F.col("order_count_vs_history_z")).alias("company_division_order"),
        F.col("order_value_vs_company_division_peer_z").alias("company_division_peer_level"),
        (~u).alias("company_division_sparse"),
        F.when(u, F.col("order_value_vs_company_division_peer_z")).otherwise(F.col("net_revenue_vs_peer_z")).alias("hybrid_peer_level"),
        F.when(u, F.col("cd_spend_residual")).otherwise(ch_spend).alias("hybrid_spend"),
        F.when(u, F.col("cd_order_residual")).otherwise(ch_order).alias("hybrid_order"),
        ((~u) & sparse_peer).alias("hybrid_sparse"),
    )


def _logged(c: str) -> Column:
    return F.when(F.col(c) > 0, F.ln(F.col(c)))


def yoy_scales(df: DataFrame) -> DataFrame:
    """One-row fit of the robust YoY scale per ratio column (MAD about zero -> IQR -> sd).

    All quantiles come from one distributed exact-percentile pass over a long table
    (ratio, kind in {abs, raw}); the fit rows are one unbounded group, so nothing is buffered."""
    from caseload.operators.ranking import exact_percentiles
    fit = df.where(F.col("fit_mask") & ((F.col(YOY[0]) > 0) | (F.col(YOY[1]) > 0)))  # few rows have a ratio
    long = fit.select(F.explode(F.array(*[F.struct(F.lit(c).alias("ratio"), _logged(c).alias("v")) for c in YOY])).alias("x")).select("x.ratio", "x.v").where("v IS NOT NULL")
    kinds = long.select("ratio", F.explode(F.array(F.struct(F.lit("abs").alias("kind"), F.abs("v").alias("val")),
                                                   F.struct(F.lit("raw").alias("kind"), F.col("v").alias("val")))).alias("y")) \
        .select("ratio", "y.kind", "y.val")
    pct = exact_percentiles(kinds, "val", {"p50": .5, "p75": .75, "p25": .25}, by=["ratio", "kind"])
    moments = long.groupBy("ratio").agg(F.stddev_pop("v").alias("sd"), F.count("v").alias("n"))
    cols = []
    for c in YOY:
        sel = F.col("ratio") == c
        cols += [F.max(F.when(sel & (F.col("kind") == "abs"), F.col("p50"))).alias(f"{c}_mad"),
                 F.max(F.when(sel & (F.col("kind") == "raw"), F.col("p75"))).alias(f"{c}_q3"),
                 F.max(F.when(sel & (F.col("kind") == "raw"), F.col("p25"))).alias(f"{c}_q1")]
    mom = [F.max(F.when(F.col("ratio") == c, F.col("sd"))).alias(f"{c}_sd") for c in YOY] + \
          [F.max(F.when(F.col("ratio") == c, F.col("n"))).alias(f"{c}_n") for c in YOY]
    fit = pct.agg(*cols).crossJoin(moments.agg(*mom))
    out = []
    for c in YOY:
        mad = F.lit(1.4826) * F.col(f"{c}_mad")
        iqr = (F.col(f"{c}_q3") - F.col(f"{c}_q1")) / F.lit(1.349)
        sd = F.col(f"{c}_sd")
        scale = F.when(mad > 0, mad).when(iqr > 0, iqr).when(sd > 0, sd)
        method = F.when(mad > 0, "MAD").when(iqr > 0, "IQR").otherwise("standard_deviation")
        out += [scale.alias(f"{c}_scale"), method.alias(f"{c}_method"),
                F.coalesce(F.col(f"{c}_n"), F.lit(0)).alias(f"{c}_observations")]
    return fit.select(*out)


def strategy_scores(df: DataFrame, scales: DataFrame, cfg: S2Config = S2Config()) -> DataFrame:
    """Max |signal| (missing -> 0) + zero-order bonus, then x multiplier if sparse."""
    df = df.crossJoin(F.broadcast(scales))
    shared = [clip(F.col(c), -10, 10) for c in S2_HISTORY_SIGNALS]
    for c in YOY:
        shared.append(clip(_logged(c) / F.col(f"{c}_scale"), -10, 10))
    bonus = F.coalesce(F.col("zero_order_month_flag"), F.lit(False)).cast("double") * F.lit(float(cfg.zero_order_bonus))
    sparse = F.coalesce(F.col("sparse_history_flag"), F.lit(True))
    size = lambda x: F.coalesce(F.abs(x), F.lit(0.0))
    kept = [c for c in df.columns if c not in scales.columns]
    df = df.select(*kept, F.greatest(*map(size, shared)).alias("_shared"), bonus.alias("_bonus"),  # the strategies have these in common
                   F.when(sparse, F.lit(float(cfg.sparse_history_multiplier))).otherwise(F.lit(1.0)).alias("_weight"))
    cols = []
    for s in STRATEGIES:
        mx = F.greatest(*[size(F.col(f"{s}_{x}")) for x in ("spend", "order", "peer_level")], F.col("_shared"))
        cols.append(F.round((mx + F.col("_bonus")) * F.col("_weight"), 9).alias(f"{s}_s2_score"))
    return df.select(*kept, *cols)


def residual_frame(scored: DataFrame, cal: SplitCalendar = DEFAULT_CALENDAR) -> tuple[DataFrame, DataFrame]:
    """S1, S6, S7, S12 over all rows: masks and residuals, and the YoY scales."""
    df = require_columns(scored, PEER_INPUT_COLUMNS)
    df = masks(df, cal)
    # the YoY fit needs only the fit mask and the ratios: read them from the masked input, not
    # from the residual/fallback frame (its quantile passes would recompute those joins)
    scales = scratch_table(yoy_scales(df.select("fit_mask", *YOY)))
    return peer_residuals(df), scales


def peer_strategy_frame(scored: DataFrame, cfg: S2Config = S2Config(), min_peer_rows: int = 5,
                        cal: SplitCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """S1-S11 over all rows: masks, residuals, fallbacks and the three strategy scores."""
    df, scales = residual_frame(scored, cal)
    return strategy_scores(fallbacks(df, min_peer_rows), scales, cfg)
