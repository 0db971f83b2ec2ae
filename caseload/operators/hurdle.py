"""Hurdle outcome scoring (H1-H7): activity surprisal, pattern surprisal, direction, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.functions.exprs import realized_prob_surprisal

PRED_COLUMNS = ("customer_public_id", "feature_month", "target_month", "data_split", "next_has_order",
                "p_next_order", "predicted_activity", "activity_surprisal", "actual_active_pattern",
                "predicted_active_pattern", "pattern_surprisal", "hurdle_direction",
                "hurdle_surprisal_score", "hurdle_eligible")


def hurdle_predictions(rows: DataFrame, *, p_col: str, pattern_pred_col: str, pattern_p_actual_col: str,
                       threshold=0.5) -> DataFrame:
    """Forward rows with ``p_col`` (P(active at t+1)), a predicted pattern and the probability the
    pattern model gave the realized pattern -> the prediction sidecar (H1-H6).
    ``threshold`` is a number (default 0.5) or the name of a column holding it."""
    y = F.col("next_has_order")
    thr = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    pred = (F.col(p_col) >= thr).cast("int")
    active = y == 1
    actual_pat = F.when(active, F.col("next_active_pattern")).otherwise("not_active")
    pred_pat = F.when(active, F.col(pattern_pred_col)).otherwise("not_active")
    pat_s = F.when(active, -F.ln(F.least(F.greatest(F.col(pattern_p_actual_col), F.lit(1e-8)), F.lit(1.0)))) \
        .otherwise(F.lit(0.0))
    df = rows.select(
        "customer_public_id", F.col("transaction_month").alias("feature_month"), "target_month", "data_split",
        y.alias("next_has_order"), F.col(p_col).alias("p_next_order"), pred.alias("predicted_activity"),
        realized_prob_surprisal(y, F.col(p_col)).alias("activity_surprisal"),
        actual_pat.alias("actual_active_pattern"), pred_pat.alias("predicted_active_pattern"),
        pat_s.alias("pattern_surprisal"))
    yy, pp = F.col("next_has_order"), F.col("predicted_activity")
    direction = (F.when((yy == 0) & (pp == 1), "unexpected_inactivity")
                  .when((yy == 1) & (pp == 0), "unexpected_activity")
                  .when((yy == 1) & (pp == 1) & (F.col("actual_active_pattern") != F.col("predicted_active_pattern")),
                        "unexpected_active_pattern")
                  .otherwise("expected"))
    df = df.withColumn("hurdle_direction", direction)
    df = df.withColumn("hurdle_surprisal_score",
                       F.round(F.greatest("activity_surprisal", "pattern_surprisal"), 9))
    return df.withColumn("hurdle_eligible", F.col("hurdle_direction") != "expected").select(*PRED_COLUMNS)


def direction_counts(pred: DataFrame) -> DataFrame:
    """H7."""
    return pred.groupBy("hurdle_direction").agg(F.count(F.lit(1)).alias("rows"))
