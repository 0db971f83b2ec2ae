"""Registered queries: lens 1 (S1-S13), queues Q1/Q2/Q6/Q7 and their evaluation aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import CAPACITIES
from caseload.operators import metrics as M
from caseload.operators.queues import jaccard, monthly_topk_ranks
from caseload.operators.ranking import spearman
from caseload.operators.s2 import STRATEGIES, yoy_scales
from caseload.plans import inputs as I
from caseload.plans import workflows as W
from caseload.plans.oracle import CTES, cte, s2_ctes, with_ctes
from caseload.plans.registry import B, R, query

KEYS = ("customer_public_id", "transaction_month")
S2 = s2_ctes(W.DRIVER_MIN_PEER_ROWS)


def _pf_cte():
    if "pf" in CTES:
        return "pf"
    ranks, flags = [], []
    for s in STRATEGIES:
        ranks.append(f"CASE WHEN eligible AND forward THEN row_number() OVER (PARTITION BY transaction_month, "
                     f"eligible AND forward ORDER BY {s}_s2_score DESC NULLS LAST, customer_public_id) END AS rn_{s}")
        for k in CAPACITIES:
            flags.append(f"coalesce(rn_{s} <= {k}, false) AS {s}_top_{k}")
    cte("pf", (S2,))(f"SELECT *, {', '.join(flags)} FROM (SELECT *, {', '.join(ranks)} FROM {S2}) r")
    return "pf"


PF = _pf_cte()
FLAGS = W.flag_columns()


def pf(spark, sf_dir):
    return W.peer_frame(spark, sf_dir)


# --------------------------------------------------------------------------- S1-S13
@query("s01_peer_group_residual", with_ctes(
    f"SELECT customer_public_id, transaction_month, {R('cd_spend_residual')}, {R('cd_order_residual')}, "
    f"cd_group_count FROM {S2}", S2))
def s01_peer_group_residual(spark, sf_dir):
    """Residual to the exact (month, company/division) median, clipped, with cell count."""
    return pf(spark, sf_dir).select(*KEYS, "cd_spend_residual", "cd_order_residual", "cd_group_count")


_FB = ["channel_spend", "channel_order", "company_division_spend", "company_division_order",
       "hybrid_peer_level", "hybrid_spend", "hybrid_order"]


@query("s02_s05_peer_fallbacks", with_ctes(
    f"SELECT customer_public_id, transaction_month, cd_usable, hybrid_sparse, "
    f"{', '.join(R(c) for c in _FB)} FROM {S2}", S2))
def s02_s05_peer_fallbacks(spark, sf_dir):
    """Usability, channel / company-division / hybrid fallbacks."""
    return pf(spark, sf_dir).select(*KEYS, "cd_usable", "hybrid_sparse", *_FB)


_YOY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS ratio, {R(c + '_scale', 'scale')}, {c}_method AS method, {c}_observations AS observations "
    f"FROM s2_{W.DRIVER_MIN_PEER_ROWS}_yoy" for c in ("net_revenue_yoy_ratio", "order_count_yoy_ratio"))


@query("s06_robust_yoy_scale", with_ctes(_YOY_SQL, f"s2_{W.DRIVER_MIN_PEER_ROWS}_yoy"))
def s06_robust_yoy_scale(spark, sf_dir):
    """Robust YoY scale per ratio (MAD about zero -> IQR -> population sd) on fit rows."""
    sc = yoy_scales(pf(spark, sf_dir))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("ratio"), F.col(f"{c}_scale").alias("scale"),
                                        F.col(f"{c}_method").alias("method"),
                                        F.col(f"{c}_observations").alias("observations"))
                               for c in ("net_revenue_yoy_ratio", "order_count_yoy_ratio")]))
    return sc.select(rows.alias("r")).select("r.*")


@query("s07_s12_masks", with_ctes(
    f"SELECT {B('sum(CASE WHEN fit_mask THEN 1 ELSE 0 END)', 'fit_rows')}, "
    f"{B('sum(CASE WHEN forward THEN 1 ELSE 0 END)', 'forward_rows')}, "
    f"{B('sum(CASE WHEN eligible THEN 1 ELSE 0 END)', 'eligible_rows')}, "
    f"{B('sum(CASE WHEN eligible AND forward THEN 1 ELSE 0 END)', 'eligible_forward_rows')} FROM {S2}", S2))
def s07_s12_masks(spark, sf_dir):
    """Fit, forward and eligibility mask sizes."""
    f = pf(spark, sf_dir)
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return f.agg(cnt(F.col("fit_mask")).alias("fit_rows"), cnt(F.col("forward")).alias("forward_rows"),
                 cnt(F.col("eligible")).alias("eligible_rows"),
                 cnt(F.col("eligible") & F.col("forward")).alias("eligible_forward_rows"))


_SC = [f"{s}_s2_score" for s in STRATEGIES]


@query("s11_strategy_scores", with_ctes(
    f"SELECT customer_public_id, transaction_month, {', '.join(R(c) for c in _SC)} FROM {S2}", S2))
def s11_strategy_scores(spark, sf_dir):
    """The three strategy scores over every customer-month."""
    return pf(spark, sf_dir).select(*KEYS, *_SC)


@query("s13_peer_forward", with_ctes(
    f"SELECT customer_public_id, transaction_month, {', '.join(R(c) for c in _SC)}, {', '.join(FLAGS)} "
    f"FROM {PF} WHERE forward", PF))
def s13_peer_forward(spark, sf_dir):
    """S13 + Q2: forward sidecar (three scores, 3x3 monthly top-K flags)."""
    return W.peer_forward(spark, sf_dir)


# --------------------------------------------------------------------------- Q1, Q2, Q6, Q7
@query("q01_topk_queue", with_ctes(
    f"SELECT customer_public_id, transaction_month, {B('rn_channel', 'queue_rank')}, {R('channel_s2_score')} "
    f"FROM {PF} WHERE rn_channel <= {max(CAPACITIES)}", PF))
def q01_topk_queue(spark, sf_dir):
    """Q1: deterministic monthly top-K queue (score desc, NULL last, customer asc)."""
    f = pf(spark, sf_dir)
    caps = CAPACITIES
    r = monthly_topk_ranks(f, "channel_s2_score", max(caps), eligible=F.col("eligible") & F.col("forward"))
    return r.join(f.select(*KEYS, "channel_s2_score"), list(KEYS))


_Q2_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS strategy, {B(str(k), 'capacity_per_month')}, "
    f"{B(f'sum(CASE WHEN {s}_top_{k} THEN 1 ELSE 0 END)', 'flagged_rows')}, "
    f"{B(f'count(DISTINCT CASE WHEN {s}_top_{k} THEN transaction_month END)', 'months')} FROM {PF}"
    for s in STRATEGIES for k in CAPACITIES)


@query("q02_flag_matrix", with_ctes(_Q2_SQL, PF))
def q02_flag_matrix(spark, sf_dir):
    """Q2: flagged rows and months for every strategy x capacity."""
    f = pf(spark, sf_dir)
    caps = CAPACITIES
    st = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.lit(k).cast("bigint").alias("capacity_per_month"),
                                      F.col(f"{s}_top_{k}").alias("flag")) for s in STRATEGIES for k in caps]))
    return f.select(KEYS[1], st.alias("x")).select(KEYS[1], "x.*").groupBy("strategy", "capacity_per_month").agg(
        F.sum(F.when(F.col("flag"), 1).otherwise(0)).cast("bigint").alias("flagged_rows"),
        F.countDistinct(F.when(F.col("flag"), F.col(KEYS[1]))).cast("bigint").alias("months"))


def _q7_sql():
    parts = []
    for k in CAPACITIES:
        for s in ("company_division", "hybrid"):
            a, b = f"channel_top_{k}", f"{s}_top_{k}"
            jac = (f"CASE WHEN sum(CASE WHEN {a} OR {b} THEN 1 ELSE 0 END) > 0 THEN "
                   f"sum(CASE WHEN {a} AND {b} THEN 1 ELSE 0 END) / sum(CASE WHEN {a} OR {b} THEN 1 ELSE 0 END) END")
            parts.append(f"""SELECT {B(str(k), 'capacity_per_month')}, 'channel_vs_{s}' AS comparison,
  (SELECT {R(jac, 'j')} FROM {PF}) AS pooled_jaccard,
  (SELECT {B(f'sum(CASE WHEN {a} <> {b} THEN 1 ELSE 0 END)', 'c')} FROM {PF}) AS changed_customer_months,
  (SELECT {R('avg(j)', 'j')} FROM (SELECT {jac} AS j FROM {PF} WHERE forward GROUP BY transaction_month) m) AS mean_monthly_jaccard""")
    return " UNION ALL ".join(parts)


@query("q07_capacity_overlap", with_ctes(_q7_sql(), PF))
def q07_capacity_overlap(spark, sf_dir):
    """Q6/Q7: pooled Jaccard, changed rows and mean monthly Jaccard per capacity x comparison."""
    f = pf(spark, sf_dir)
    caps = CAPACITIES
    out = None
    for k in caps:
        for s in ("company_division", "hybrid"):
            a, b = f"channel_top_{k}", f"{s}_top_{k}"
            pooled = f.agg(jaccard(a, b).alias("pooled_jaccard"),
                           F.sum(F.when(F.col(a) != F.col(b), 1).otherwise(0)).cast("bigint").alias("changed_customer_months"))
            monthly = f.where("forward").groupBy(KEYS[1]).agg(jaccard(a, b).alias("j")).agg(
                F.avg("j").alias("mean_monthly_jaccard"))
            row = pooled.crossJoin(monthly).select(
                F.lit(k).cast("bigint").alias("capacity_per_month"), F.lit(f"channel_vs_{s}").alias("comparison"),
                "pooled_jaccard", "changed_customer_months", "mean_monthly_jaccard")
            out = row if out is None else out.unionByName(row)
    return out


# --------------------------------------------------------------------------- E11-E17, C10, X1-X3
def _spearman_sql(x, y, where):
    return f"""(SELECT corr(rx, ry) FROM (
      SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
      FROM {PF} WHERE {where} AND {x} IS NOT NULL AND {y} IS NOT NULL) r)"""


_E13_SQL = " UNION ALL ".join(
    f"""SELECT '{s}' AS strategy, (SELECT count(*) FROM {PF} WHERE forward) AS forward_rows,
  (SELECT {R(f'avg(CAST({s}_sparse AS DOUBLE))', 'x')} FROM {PF} WHERE forward) AS sparse_peer_rate,
  round({_spearman_sql(f'{s}_s2_score', 'channel_s2_score', 'forward')}, 6) + 0.0 AS spearman_vs_channel,
  (SELECT {R(f'corr({s}_s2_score, channel_s2_score)', 'x')} FROM {PF} WHERE forward) AS pearson_vs_channel"""
    for s in STRATEGIES)


@query("e13_strategy_metrics", with_ctes(_E13_SQL, PF))
def e13_strategy_metrics(spark, sf_dir):
    """Forward rows, sparse rate, Spearman and Pearson vs the channel score.

    Strategy scores are never NULL (S8 maps missing signals to 0), so every pair uses all
    forward rows and each score column is ranked once, then correlated with the channel ranks."""
    from caseload.operators.ranking import average_rank
    f = pf(spark, sf_dir).where("forward")
    ranked = f.select(*KEYS, *[f"{s}_s2_score" for s in STRATEGIES], *[f"{s}_sparse" for s in STRATEGIES])
    for s in STRATEGIES:
        ranked = average_rank(ranked, f"{s}_s2_score", f"_r_{s}")
    aggs = [F.count(F.lit(1)).alias("forward_rows")]
    for s in STRATEGIES:
        aggs += [F.avg(F.col(f"{s}_sparse").cast("double")).alias(f"{s}__sparse_peer_rate"),
                 F.corr(f"_r_{s}", "_r_channel").alias(f"{s}__spearman_vs_channel"),
                 F.corr(f"{s}_s2_score", "channel_s2_score").alias(f"{s}__pearson_vs_channel")]
    wide = ranked.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col("forward_rows").alias("forward_rows"),
                                        F.col(f"{s}__sparse_peer_rate").alias("sparse_peer_rate"),
                                        F.col(f"{s}__spearman_vs_channel").alias("spearman_vs_channel"),
                                        F.col(f"{s}__pearson_vs_channel").alias("pearson_vs_channel"))
                               for s in STRATEGIES]))
    return wide.select(rows.alias("r")).select("r.*")


_E11_SQL = (f"SELECT (SELECT {R('corr(channel_s2_score, baseline_anomaly_score)', 'x')} FROM {PF} WHERE forward) "
    f"AS pearson_recomputed_channel_vs_current_s2, "
    f"round({_spearman_sql('channel_s2_score', 'round(baseline_anomaly_score, 9)', 'forward')}, 6) + 0.0 "
    f"AS spearman_recomputed_channel_vs_current_s2")


@query("e11_e12_baseline_reproduction", with_ctes(_E11_SQL, PF))
def e11_e12_baseline_reproduction(spark, sf_dir):
    """Pearson and Spearman of the channel score vs the panel's baseline anomaly score."""
    f = pf(spark, sf_dir).where("forward")
    p = f.agg(F.corr("channel_s2_score", "baseline_anomaly_score").alias("pearson_recomputed_channel_vs_current_s2"))
    f = f.withColumn("baseline_r9", F.round("baseline_anomaly_score", 9))
    s = spearman(f, "channel_s2_score", "baseline_r9").withColumnRenamed(
        "spearman", "spearman_recomputed_channel_vs_current_s2")
    return p.crossJoin(s)


_E14_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS strategy, {R(f'avg({s}_s2_score)', 'mean')}, {R(f'median({s}_s2_score)', 'median')}, "
    f"{R(f'quantile_cont({s}_s2_score, 0.95)', 'p95')}, {R(f'quantile_cont({s}_s2_score, 0.99)', 'p99')}, "
    f"{R(f'max({s}_s2_score)', 'max')} FROM {PF} WHERE forward" for s in STRATEGIES)


@query("e14_score_distribution", with_ctes(_E14_SQL, PF))
def e14_score_distribution(spark, sf_dir):
    """Mean, median, p95, p99, max of each strategy score over the forward window."""
    from caseload.operators.ranking import exact_percentiles
    long = pf(spark, sf_dir).where("forward").select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("strategy"), F.col(f"{s}_s2_score").alias("score")) for s in STRATEGIES])).alias("x")).select("x.*")
    moments = long.groupBy("strategy").agg(F.avg("score").alias("mean"), F.max("score").alias("max"))
    return moments.join(exact_percentiles(long, "score", {"median": .5, "p95": .95, "p99": .99}, by=["strategy"]), "strategy")


_E15_SQL = (f"""
SELECT {R('m.company_division_s2_score', 'max_score')},
       NOT m.cd_usable AS max_score_uses_sparse_company_division_peer_cell,
       m.company_division_peer_customer_count AS max_score_company_division_peer_customer_count,
       m.cd_group_count AS max_score_peer_residual_rows,
       (SELECT count(*) FROM {PF} WHERE forward AND company_division_s2_score >=
          (SELECT quantile_cont(company_division_s2_score, 0.99) FROM {PF} WHERE forward)) AS top_one_percent_rows,
       (SELECT {R('avg(CAST(NOT cd_usable AS DOUBLE))', 'x')} FROM {PF} WHERE forward AND company_division_s2_score >=
          (SELECT quantile_cont(company_division_s2_score, 0.99) FROM {PF} WHERE forward))
         AS top_one_percent_sparse_company_division_peer_cell_rate
FROM (SELECT * FROM {PF} WHERE forward
      ORDER BY company_division_s2_score DESC NULLS LAST, customer_public_id, transaction_month LIMIT 1) m""")


@query("e15_tail_diagnostic", with_ctes(_E15_SQL, PF))
def e15_tail_diagnostic(spark, sf_dir):
    """The max company/division row (key tie-break) and the top-1 % rows' sparse rate."""
    f = pf(spark, sf_dir).where("forward")
    # tie-break: smallest customer id, then earliest month
    top = f.orderBy(F.desc_nulls_last("company_division_s2_score"), KEYS[0], KEYS[1]).limit(1).select(
        F.col("company_division_s2_score").alias("max_score"),
        (~F.col("cd_usable")).alias("max_score_uses_sparse_company_division_peer_cell"),
        F.col("company_division_peer_customer_count").alias("max_score_company_division_peer_customer_count"),
        F.col("cd_group_count").alias("max_score_peer_residual_rows"))
    from caseload.operators.ranking import exact_percentiles
    thr = exact_percentiles(f, "company_division_s2_score", {"thr": 0.99})
    tail = f.crossJoin(thr).where(F.col("company_division_s2_score") >= F.col("thr")).agg(
        F.count(F.lit(1)).alias("top_one_percent_rows"),
        F.avg((~F.col("cd_usable")).cast("double")).alias("top_one_percent_sparse_company_division_peer_cell_rate"))
    return top.crossJoin(tail)


_E17_SQL = (f"SELECT {R('avg(CAST(cd_usable AS DOUBLE))', 'company_division_usable_non_sparse_peer_rate')} "
    f"FROM {PF} WHERE forward")


@query("e17_usable_peer_rate", with_ctes(_E17_SQL, PF))
def e17_usable_peer_rate(spark, sf_dir):
    """Share of forward rows in a usable company/division peer cell."""
    return pf(spark, sf_dir).where("forward").agg(
        F.avg(F.col("cd_usable").cast("double")).alias("company_division_usable_non_sparse_peer_rate"))


_C10_SQL = (f"""
SELECT count(*) AS customer_month_rows, count(DISTINCT customer_public_id) AS distinct_customers,
       count(DISTINCT transaction_month) AS months, min(transaction_month) AS month_start,
       max(transaction_month) AS month_end,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_public_id, transaction_month FROM {PF}) d)
         AS duplicate_customer_month_rows,
       {R('avg(CAST(zero_order_month_flag AS DOUBLE))', 'zero_order_month_rate')},
       {R('avg(CAST(coalesce(sparse_history_flag, true) AS DOUBLE))', 'sparse_history_rate')},
       {B('sum(CASE WHEN channel_s2_score IS NULL THEN 1 ELSE 0 END)', 'channel_null_scores')},
       {B('sum(CASE WHEN company_division_s2_score IS NULL THEN 1 ELSE 0 END)', 'company_division_null_scores')},
       {B('sum(CASE WHEN hybrid_s2_score IS NULL THEN 1 ELSE 0 END)', 'hybrid_null_scores')}
FROM {PF}""")


@query("c10_panel_quality", with_ctes(_C10_SQL, PF))
def c10_panel_quality(spark, sf_dir):
    """Rows, customers, months, range, duplicates, zero-order and sparse rates, NULL scores."""
    from caseload.operators.clean import panel_quality
    return panel_quality(pf(spark, sf_dir), _SC)


_E16_SQL = (f"SELECT transaction_month, count(*) AS customer_month_rows, "
    f"{R('1 - avg(CAST(zero_order_month_flag AS DOUBLE))', 'activity_rate')} FROM {PF} GROUP BY transaction_month")


@query("e16_monthly_activity", with_ctes(_E16_SQL, PF))
def e16_monthly_activity(spark, sf_dir):
    """Monthly rows and activity rate (1 - zero-order mean)."""
    from caseload.operators.clean import monthly_activity
    return monthly_activity(pf(spark, sf_dir))


@query("x01_channel_histogram", with_ctes(f"""
SELECT {B('b', 'bin')}, count(*) AS rows, {R('mn + b * w', 'bin_lower')}, {R('mn + (b + 1) * w', 'bin_upper')}
FROM (SELECT least(CAST(floor((channel_s2_score - mn) / w) AS BIGINT), 49) AS b, mn, w
      FROM {PF} CROSS JOIN (SELECT min(channel_s2_score) AS mn,
                                   (max(channel_s2_score) - min(channel_s2_score)) / 50.0 AS w
                            FROM {PF} WHERE forward) s
      WHERE forward AND channel_s2_score IS NOT NULL AND w > 0) h
GROUP BY b, mn, w""", PF))
def x01_channel_histogram(spark, sf_dir):
    """50-bin histogram of the forward channel score."""
    from caseload.operators.explore import histogram
    return histogram(pf(spark, sf_dir).where("forward"), "channel_s2_score", 50)


@query("x02_forward_activity_mix", with_ctes(f"""
SELECT {B('sum(CASE WHEN zero_order_month_flag THEN 0 ELSE 1 END)', 'active_rows')},
       {B('sum(CASE WHEN zero_order_month_flag THEN 1 ELSE 0 END)', 'zero_order_rows')},
       {R('avg(CASE WHEN zero_order_month_flag THEN 0.0 ELSE 1.0 END)', 'active_share')}
FROM {PF} WHERE forward""", PF))
def x02_forward_activity_mix(spark, sf_dir):
    """Forward activity mix (counts and share)."""
    f = pf(spark, sf_dir).where("forward")
    z = F.col("zero_order_month_flag")
    return f.agg(F.sum(F.when(z, 0).otherwise(1)).cast("bigint").alias("active_rows"),
                 F.sum(F.when(z, 1).otherwise(0)).cast("bigint").alias("zero_order_rows"),
                 F.avg(F.when(z, 0.0).otherwise(1.0)).alias("active_share"))


_X3_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')}, "
    f"{R(f'min({c})', 'min')}, {R(f'quantile_cont({c}, 0.25)', 'p25')}, {R(f'median({c})', 'median')}, "
    f"{R(f'quantile_cont({c}, 0.75)', 'p75')}, {R(f'quantile_cont({c}, 0.95)', 'p95')}, "
    f"{R(f'quantile_cont({c}, 0.99)', 'p99')}, {R(f'max({c})', 'max')} FROM {PF} WHERE forward" for c in _SC)


@query("x03_describe_scores", with_ctes(_X3_SQL, PF))
def x03_describe_scores(spark, sf_dir):
    """Exact describe of the three forward scores."""
    return M.describe(pf(spark, sf_dir).where("forward"), _SC)


# --------------------------------------------------------------------------- S13: the whole record
def _cells(section: str, key: str, metrics: dict[str, str], source: str) -> str:
    """One row of ``source`` as rows (section, key, metric, value)."""
    names, values = ", ".join(f"'{m}'" for m in metrics), ", ".join(f"CAST({c} AS DOUBLE)" for c in metrics.values())
    return f"SELECT '{section}' AS section, CAST({key} AS VARCHAR) AS key, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM ({source}) t"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _number(c: str) -> str:
    return f"year({c}) * 100 + month({c})"


_TAIL = ("max_score", "max_score_uses_sparse_company_division_peer_cell", "max_score_company_division_peer_customer_count",
         "max_score_peer_residual_rows", "top_one_percent_rows", "top_one_percent_sparse_company_division_peer_cell_rate")
_QUALITY = ("customer_month_rows", "distinct_customers", "months", "duplicate_customer_month_rows", "zero_order_month_rate",
            "sparse_history_rate", *[f"{s}_null_scores" for s in STRATEGIES])
_COUNTS = f"SELECT count(*) AS n, count(*) FILTER (WHERE forward) AS f FROM {PF}"
_RECORD_SQL = " UNION ALL ".join([
    _cells("forward_months", "'window'", {"start": _number(W.DEFAULT_CALENDAR.sql_date("forward_start")), "end": _number(W.DEFAULT_CALENDAR.sql_date("forward_end"))}, "SELECT 1"),
    _cells("capacities_per_month", "k", {"capacity": "k"}, f"SELECT unnest({list(CAPACITIES)}) AS k"),
    _cells("strategy_metrics", "strategy", _same("forward_rows", "sparse_peer_rate", "spearman_vs_channel", "pearson_vs_channel"), _E13_SQL),
    _cells("score_distribution", "strategy", _same("mean", "median", "p95", "p99", "max"), _E14_SQL),
    _cells("capacity_overlap", "capacity_per_month || '|' || comparison", _same("pooled_jaccard", "changed_customer_months", "mean_monthly_jaccard"), _q7_sql()),
    _cells("baseline_reproduction", "'channel_vs_current_s2'", {"pearson": "pearson_recomputed_channel_vs_current_s2", "spearman": "spearman_recomputed_channel_vs_current_s2"}, _E11_SQL),
    _cells("company_division_usable_non_sparse_peer_rate", "'forward'", {"rate": "company_division_usable_non_sparse_peer_rate"}, _E17_SQL),
    _cells("data_quality", "'panel'", {**_same(*_QUALITY), "month_start": _number("month_start"), "month_end": _number("month_end")}, _C10_SQL),
    _cells("company_division_tail_diagnostic", "'forward'", _same(*_TAIL), _E15_SQL),
    _cells("yoy_calibration", "ratio", _same("scale", "observations"), _YOY_SQL),
    f"SELECT 'yoy_calibration', ratio, 'method=' || method, 1.0 FROM ({_YOY_SQL}) t",
    _cells("s2_score_config", "'workflow_defaults'", {"aggregation=maximum_absolute_signal": "1", "zero_order_bonus": "0.75", "sparse_history_multiplier": "0.75"}, "SELECT 1"),
    _cells("peer_input", "'workflow_panel'", {"rows": "n"}, _COUNTS),
    _cells("output", "'peer_forward'", {"rows": "f", "columns": str(2 + len(_SC) + len(FLAGS))}, _COUNTS),
    _cells("monthly_activity_rate", "strftime(transaction_month, '%Y-%m')", _same("customer_month_rows", "activity_rate"), _E16_SQL),
])


@query("s13_peer_record", with_ctes(_RECORD_SQL, PF, f"s2_{W.DRIVER_MIN_PEER_ROWS}_yoy"))
def s13_peer_record(spark, sf_dir):
    """The whole metric record of lens 1 in one pass over months and one over ranks."""
    from caseload.plans.entrypoints import run_peer_strategy_evaluation
    return run_peer_strategy_evaluation(spark, sf_dir)[0]
