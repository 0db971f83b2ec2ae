"""Evaluation aggregates (E1-E8, E11-E18, X*) as grouped aggregates over probability tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.functions.exprs import clip_prob
from caseload.operators.ranking import auc_ap


def long_probabilities(df: DataFrame, label: str, models: dict[str, str], keep=()) -> DataFrame:
    """Melt model probability columns into (model, y, p) rows; p clipped to [1e-8, 1-1e-8]."""
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("p"))
                             for m, c in models.items()]))
    return df.select(*keep, F.col(label).cast("int").alias("y"), st.alias("_m")).select(
        *keep, "y", F.col("_m.model").alias("model"), clip_prob(F.col("_m.p")).alias("p"))


def binary_metrics(long_df: DataFrame, threshold: float = 0.5, by=("model",)) -> DataFrame:
    """Rows, activity rate, accuracy, balanced accuracy, F1, AUC, AP, log loss, Brier."""
    by = list(by)
    y, p = F.col("y"), F.col("p")
    pred = (p >= threshold).cast("int")
    base = long_df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(y.cast("double")).alias("activity_rate"),
        F.sum(F.when((pred == 1) & (y == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((pred == 1) & (y == 0), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((pred == 0) & (y == 1), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((pred == 0) & (y == 0), 1).otherwise(0)).alias("tn"),
        F.avg(-(y * F.ln(p) + (F.lit(1) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss"),
        F.avg((p - y) * (p - y)).alias("brier"),
    )
    ranks = auc_ap(long_df, "y", "p", by=by)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    tpr = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    tnr = F.when(tn + fp > 0, tn / (tn + fp)).otherwise(F.lit(0.0))
    n_classes = F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0)
    return base.join(ranks, by, "left").select(
        *by, F.col("rows").cast("bigint").alias("rows"), "activity_rate",
        ((tp + tn) / F.col("rows")).alias("accuracy"),
        ((tpr + tnr) / n_classes).alias("balanced_accuracy"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0)).alias("f1"),
        "roc_auc", "average_precision", "log_loss", "brier")


def reliability_bins(long_df: DataFrame, n_bins: int = 8, by=("model",)) -> DataFrame:
    """Fixed-width bins ``least(floor(p*B), B-1)``; empty bins omitted (p clipped to [0,1])."""
    if n_bins < 2:
        raise ValueError("n_bins must be at least 2")
    p = F.least(F.greatest(F.col("p"), F.lit(0.0)), F.lit(1.0))
    b = F.least(F.floor(p * n_bins), F.lit(n_bins - 1)).cast("bigint")
    return long_df.select(*by, "y", p.alias("p"), b.alias("bin0")).groupBy(*by, "bin0").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("p").alias("mean_predicted_probability"),
        F.avg(F.col("y").cast("double")).alias("observed_activity_rate")).select(
        *by, (F.col("bin0") + 1).alias("bin"), (F.col("bin0") / F.lit(float(n_bins))).alias("probability_lower"),
        ((F.col("bin0") + 1) / F.lit(float(n_bins))).alias("probability_upper"), "rows",
        "mean_predicted_probability", "observed_activity_rate")


def describe(df: DataFrame, columns, name_col: str = "column") -> DataFrame:
    """Exact count, mean, sd, min, quartiles, p95, p99, max per column (long form)."""
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias("v"))
                               for c in columns]))
    from caseload.operators.ranking import exact_percentiles
    long = df.select(rows.alias("_r")).select(f"_r.{name_col}", "_r.v")
    basic = long.groupBy(name_col).agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                       F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    pct = exact_percentiles(long, "v", {"p25": .25, "median": .5, "p75": .75, "p95": .95, "p99": .99}, by=[name_col])
    return basic.join(pct, name_col).select(name_col, "count", "mean", "std", "min", "p25", "median", "p75", "p95",
                                            "p99", "max")


def stack_metrics(df: DataFrame, id_cols, metric_cols, name="metric", value="value") -> DataFrame:
    """Wide one-row-per-id -> long (id..., metric, value) table."""
    st = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                             for c in metric_cols]))
    return df.select(*id_cols, st.alias("_s")).select(*id_cols, f"_s.{name}", f"_s.{value}")


def multiclass_metrics(df: DataFrame, actual: str, predicted: str, p_actual: Column) -> DataFrame:
    """Accuracy, macro-F1 over classes seen in truth or prediction, log loss, majority accuracy."""
    base = df.select(F.col(actual).alias("a"), F.col(predicted).alias("p"), p_actual.alias("pa"))
    tot = base.agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("a") == F.col("p")).cast("double")).alias("accuracy"),
                   F.avg(-F.ln(F.least(F.greatest(F.col("pa"), F.lit(1e-15)), F.lit(1.0)))).alias("log_loss"))
    truth = base.groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    predc = base.groupBy(F.col("p").alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    hits = base.where(F.col("a") == F.col("p")).groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("tp"))
    per = truth.join(predc, "cls", "full").join(hits, "cls", "left").fillna(0, ["support", "predicted", "tp"])
    f1 = F.when(F.col("support") + F.col("predicted") > 0,
                2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(F.lit(0.0))
    macro = per.agg(F.avg(f1).alias("macro_f1"), F.max("support").alias("_maj"))
    return tot.crossJoin(macro).select("rows", "accuracy", "macro_f1", "log_loss",
                                       (F.col("_maj") / F.col("rows")).alias("majority_accuracy"))
