"""Registered queries: lens 2 baselines, folds, hurdle scoring and forward metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.operators import baselines as BL
from caseload.operators import metrics as M
from caseload.operators.hurdle import PRED_COLUMNS, direction_counts
from caseload.plans import inputs as I
from caseload.plans import workflows as W
from caseload.plans.oracle import cte, with_ctes
from caseload.plans.registry import B, R, query

def _train():
    return F.col("data_split") == "train"


@query("m01_markov_baseline", with_ctes(f"SELECT {B('current_has_order')}, {R('p_markov')} FROM mk", "mk"))
def m01_markov_baseline(spark, sf_dir):
    """M1: smoothed one-step Markov table fitted on train."""
    return BL.markov_table(I.cadence(spark, sf_dir).where(_train()))


@query("m02_global_rate", with_ctes(f"SELECT {R('p_global')} FROM gl", "gl"))
def m02_global_rate(spark, sf_dir):
    """M2: constant train activity rate."""
    return BL.global_rate(I.cadence(spark, sf_dir).where(_train()))


@query("m03_pattern_thresholds", with_ctes(
    f"SELECT {R('discount_p90')}, {R('breadth_p75')}, {R('orders_p75')} FROM pthr", "pthr"))
def m03_pattern_thresholds(spark, sf_dir):
    """M3: exact train-active quantile thresholds."""
    return BL.pattern_thresholds(I.cadence(spark, sf_dir))


@query("m04_pattern_labels", with_ctes(
    "SELECT customer_public_id, transaction_month, data_split, next_active_pattern FROM lab", "lab"))
def m04_pattern_labels(spark, sf_dir):
    """M4: ordered pattern label for every cadence row."""
    return W.labeled_cadence(spark, sf_dir).select("customer_public_id", "transaction_month", "data_split",
                                                    "next_active_pattern")


cte("fold_months", ("cadence",))("""
  SELECT target_month, pos, m, blocks,
         CASE WHEN pos < r * (q + 1) THEN floor(pos / (q + 1)) ELSE r + floor((pos - r * (q + 1)) / q) END + 1 AS block
  FROM (SELECT *, floor(m / blocks) AS q, m - floor(m / blocks) * blocks AS r
        FROM (SELECT target_month, row_number() OVER (ORDER BY target_month) - 1 AS pos,
                     count(*) OVER () AS m,
                     CASE WHEN count(*) OVER () < 5 THEN greatest(1, count(*) OVER () - 1) ELSE 4 END + 1 AS blocks
              FROM (SELECT DISTINCT target_month FROM cadence WHERE data_split = 'train') d) a) b""")
cte("folds", ("fold_months",))("""
  SELECT f.fold, CASE WHEN m.block <= f.fold THEN 'train' ELSE 'validation' END AS role, m.target_month
  FROM fold_months m CROSS JOIN (SELECT unnest(range(1, 5)) AS fold) f
  WHERE f.fold <= m.blocks - 1 AND (m.block <= f.fold OR m.block = f.fold + 1)""")


@query("m05_expanding_folds", with_ctes(f"SELECT {B('fold')}, role, target_month FROM folds", "folds"))
def m05_expanding_folds(spark, sf_dir):
    """M5: expanding-window folds over train target months (4 folds, array_split blocks)."""
    return BL.expanding_folds(I.cadence(spark, sf_dir), _train(), 4)


@query("m06_fold_boundaries", with_ctes("""
SELECT CAST(fold AS BIGINT) AS fold,
       min(CASE WHEN role = 'train' THEN target_month END) AS train_start,
       max(CASE WHEN role = 'train' THEN target_month END) AS train_end,
       min(CASE WHEN role = 'validation' THEN target_month END) AS validation_start,
       max(CASE WHEN role = 'validation' THEN target_month END) AS validation_end,
       CAST(sum(CASE WHEN role = 'train' THEN n ELSE 0 END) AS BIGINT) AS train_rows,
       CAST(sum(CASE WHEN role = 'validation' THEN n ELSE 0 END) AS BIGINT) AS validation_rows
FROM folds JOIN (SELECT target_month, count(*) AS n FROM cadence WHERE data_split = 'train' GROUP BY 1) c USING (target_month)
GROUP BY fold""", "folds", "cadence"))
def m06_fold_boundaries(spark, sf_dir):
    """M6: fold boundary table (months and rows, no customer ids)."""
    return BL.fold_boundaries(I.cadence(spark, sf_dir), _train(), 4)


_PRED_SQL_COLS = []
for _c in PRED_COLUMNS:
    if _c in ("p_next_order", "activity_surprisal", "pattern_surprisal", "hurdle_surprisal_score"):
        _PRED_SQL_COLS.append(R(_c))
    elif _c in ("next_has_order", "predicted_activity"):
        _PRED_SQL_COLS.append(B(_c))
    else:
        _PRED_SQL_COLS.append(_c)


@query("h01_h06_forward_predictions", with_ctes(f"SELECT {', '.join(_PRED_SQL_COLS)} FROM hb", "hb"))
def h01_h06_forward_predictions(spark, sf_dir):
    """H1-H6: forward prediction sidecar (activity + pattern surprisal, direction, score, eligibility)."""
    return W.hurdle_baseline(spark, sf_dir)


@query("h07_direction_counts", with_ctes("SELECT hurdle_direction, count(*) AS rows FROM hb GROUP BY 1", "hb"))
def h07_direction_counts(spark, sf_dir):
    """H7: forward direction counts."""
    return direction_counts(W.hurdle_baseline(spark, sf_dir))


# --------------------------------------------------------------------------- E1-E8
def forward_long(spark, sf_dir):
    cad = I.cadence(spark, sf_dir)
    fwd = BL.apply_baselines(cad.where(F.col("data_split") == "forward"), cad.where(_train()))
    return M.long_probabilities(fwd, "next_has_order", {"smoothed_activity_markov": "p_markov",
                                                        "global_activity_rate": "p_global"},
                                keep=("customer_public_id",))


cte("flong", ("cadence", "mk", "gl"))("""
  SELECT c.customer_public_id, CAST(c.next_has_order AS INTEGER) AS y, m.model,
         least(greatest(m.p, 1e-8), 1 - 1e-8) AS p
  FROM cadence c LEFT JOIN mk ON c.current_has_order = mk.current_has_order CROSS JOIN gl
  CROSS JOIN LATERAL (VALUES ('smoothed_activity_markov', coalesce(mk.p_markov, gl.p_global)),
                             ('global_activity_rate', gl.p_global)) m(model, p)
  WHERE c.data_split = 'forward'""")


def binary_metrics_sql(long_cte: str) -> str:
    return f"""
SELECT b.model, b.rows, {R('b.activity_rate', 'activity_rate')},
  {R('(b.tp + b.tn) / b.rows', 'accuracy')},
  {R('((CASE WHEN b.tp + b.fn > 0 THEN b.tp / (b.tp + b.fn) ELSE 0 END) + (CASE WHEN b.tn + b.fp > 0 THEN b.tn / (b.tn + b.fp) ELSE 0 END)) / ((CASE WHEN b.tp + b.fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN b.tn + b.fp > 0 THEN 1 ELSE 0 END))', 'balanced_accuracy')},
  {R('CASE WHEN 2 * b.tp + b.fp + b.fn > 0 THEN 2 * b.tp / (2 * b.tp + b.fp + b.fn) ELSE 0 END', 'f1')},
  {R('r.roc_auc', 'roc_auc')}, {R('r.average_precision', 'average_precision')},
  {R('b.log_loss', 'log_loss')}, {R('b.brier', 'brier')}
FROM (SELECT model, count(*) AS rows, avg(CAST(y AS DOUBLE)) AS activity_rate,
             CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(sum(CASE WHEN p >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
             CAST(sum(CASE WHEN p < 0.5 AND y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
             avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS log_loss, avg((p - y) * (p - y)) AS brier
      FROM {long_cte} GROUP BY model) b
LEFT JOIN (
  SELECT model, CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)) END AS roc_auc,
         CASE WHEN max(tot_pos) > 0 THEN sum((pos / tot_pos) * ((tot_pos - pos_below) / (tot_pos + tot_neg - pos_below - neg_below))) END AS average_precision
  FROM (SELECT *, coalesce(sum(pos) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
               sum(pos) OVER (PARTITION BY model) AS tot_pos, sum(neg) OVER (PARTITION BY model) AS tot_neg
        FROM (SELECT model, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
              FROM {long_cte} GROUP BY model, p) c) d
  GROUP BY model) r USING (model)"""


@query("e01_e06_forward_metrics", with_ctes(binary_metrics_sql("flong"), "flong"))
def e01_e06_forward_metrics(spark, sf_dir):
    """Log loss, Brier, accuracy, balanced accuracy, F1, ROC-AUC, AP per baseline model."""
    return M.binary_metrics(forward_long(spark, sf_dir))


@query("e07_reliability_bins", with_ctes(f"""
SELECT model, CAST(b0 + 1 AS BIGINT) AS bin, {R('b0 / 8.0', 'probability_lower')}, {R('(b0 + 1) / 8.0', 'probability_upper')},
       count(*) AS rows, {R('avg(pc)', 'mean_predicted_probability')}, {R('avg(CAST(y AS DOUBLE))', 'observed_activity_rate')}
FROM (SELECT model, y, least(greatest(p, 0.0), 1.0) AS pc,
             least(CAST(floor(least(greatest(p, 0.0), 1.0) * 8) AS BIGINT), 7) AS b0 FROM flong) x
GROUP BY model, b0""", "flong"))
def e07_reliability_bins(spark, sf_dir):
    """Eight fixed-width reliability bins per model (empty bins omitted)."""
    return M.reliability_bins(forward_long(spark, sf_dir), 8)


cte("e8", ("lab", "pprior", "pmaj"))("""
  SELECT l.next_active_pattern AS a, m.majority_pattern AS p, coalesce(pp.pattern_share, 0.0) AS pa
  FROM lab l CROSS JOIN pmaj m LEFT JOIN pprior pp ON l.next_active_pattern = pp.pattern_class
  WHERE l.data_split = 'forward' AND l.next_has_order = 1""")


@query("e08_pattern_metrics", with_ctes(f"""
SELECT count(*) AS rows, {R('avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END)', 'accuracy')},
       {R('(SELECT avg(CASE WHEN s + pc > 0 THEN 2.0 * tp / (s + pc) ELSE 0.0 END) FROM (SELECT cls, coalesce(s, 0) AS s, coalesce(pc, 0) AS pc, coalesce(tp, 0) AS tp FROM (SELECT a AS cls, count(*) AS s FROM e8 GROUP BY a) t FULL JOIN (SELECT p AS cls, count(*) AS pc FROM e8 GROUP BY p) u USING (cls) LEFT JOIN (SELECT a AS cls, count(*) AS tp FROM e8 WHERE a = p GROUP BY a) v USING (cls)) z)', 'macro_f1')},
       {R('avg(-ln(least(greatest(pa, 1e-15), 1.0)))', 'log_loss')},
       {R('(SELECT max(n) FROM (SELECT count(*) AS n FROM e8 GROUP BY a) q) / count(*)', 'majority_accuracy')}
FROM e8""", "e8"))
def e08_pattern_metrics(spark, sf_dir):
    """Stage-2 multiclass metrics on forward active rows (class-prior pattern model)."""
    cad = W.labeled_cadence(spark, sf_dir)
    shares, majority = BL.pattern_prior(cad.where(_train()))
    fa = cad.where((F.col("data_split") == "forward") & (F.col("next_has_order") == 1))
    fa = fa.crossJoin(F.broadcast(majority)).join(F.broadcast(shares),
                                                   F.col("next_active_pattern") == F.col("pattern_class"), "left")
    return M.multiclass_metrics(fa, "next_active_pattern", "majority_pattern", F.coalesce("pattern_share", F.lit(0.0)))


@query("e18_panel_counts", with_ctes(
    "SELECT count(*) AS panel_rows, count(DISTINCT customer_public_id) AS customers FROM cadence", "cadence"))
def e18_panel_counts(spark, sf_dir):
    """Cadence panel rows and customers (split rows are ``k15_split_counts``)."""
    return I.cadence(spark, sf_dir).agg(F.count(F.lit(1)).alias("panel_rows"),
                                        F.countDistinct("customer_public_id").alias("customers"))
