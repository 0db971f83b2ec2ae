"""Registered queries: figure aggregates (X4, X6-X11) and evidence sinks (SNK3, SNK4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import CAPACITIES, PILOT_TARGETS
from caseload.operators import explore as X
from caseload.operators import metrics as M
from caseload.plans import workflows as W
from caseload.plans.oracle import with_ctes
from caseload.plans.q_hurdle import binary_metrics_sql, forward_long
from caseload.plans.q_ops import ALLOC
from caseload.plans.registry import R, query
from caseload.plans.stages import stage_path
from caseload.sources import sinks


@query("x04_probability_by_direction", with_ctes(f"""
SELECT hurdle_direction, count(*) AS count, {R('avg(p_next_order)', 'mean')}, {R('stddev_samp(p_next_order)', 'std')},
       {R('min(p_next_order)', 'min')}, {R('quantile_cont(p_next_order, 0.25)', 'p25')}, {R('median(p_next_order)', 'median')},
       {R('quantile_cont(p_next_order, 0.75)', 'p75')}, {R('max(p_next_order)', 'max')}
FROM hb GROUP BY hurdle_direction""", "hb"))
def x04_probability_by_direction(spark, sf_dir):
    """Grouped describe of P(next order) by hurdle direction."""
    from caseload.operators.ranking import exact_percentiles
    p = F.col("p_next_order")
    h = W.hurdle_baseline(spark, sf_dir)
    basic = h.groupBy("hurdle_direction").agg(F.count(p).alias("count"), F.avg(p).alias("mean"),
                                              F.stddev_samp(p).alias("std"), F.min(p).alias("min"), F.max(p).alias("max"))
    pct = exact_percentiles(h, "p_next_order", {"p25": .25, "median": .5, "p75": .75}, by=["hurdle_direction"])
    return basic.join(pct, "hurdle_direction").select("hurdle_direction", "count", "mean", "std", "min", "p25",
                                                      "median", "p75", "max")


@query("x06_roc_points", with_ctes(f"""
SELECT model, {R('p', 'threshold')}, {R('(tp - pos_below) / tp', 'tpr')}, {R('(tn - neg_below) / tn', 'fpr')} FROM (
  SELECT *, coalesce(sum(pos) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
         coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
         sum(pos) OVER (PARTITION BY model) AS tp, sum(neg) OVER (PARTITION BY model) AS tn
  FROM (SELECT model, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM flong GROUP BY model, p) a) b""",
    "flong"))
def x06_roc_points(spark, sf_dir):
    """ROC curve points per model and threshold."""
    return X.roc_points(forward_long(spark, sf_dir))


@query("x07_density_by_outcome", with_ctes(f"""
SELECT CAST(c.outcome AS BIGINT) AS outcome, c.bin, c.rows, {R('c.rows / (t.n * (1.0 / 40))', 'density')} FROM
  (SELECT y AS outcome, least(CAST(floor(p * 40) AS BIGINT), 39) AS bin, count(*) AS rows
   FROM flong WHERE model = 'smoothed_activity_markov' GROUP BY 1, 2) c
JOIN (SELECT y AS outcome, count(*) AS n FROM flong WHERE model = 'smoothed_activity_markov' GROUP BY 1) t USING (outcome)""",
    "flong"))
def x07_density_by_outcome(spark, sf_dir):
    """40-bin probability density per realized outcome, each normalized on its own."""
    lf = forward_long(spark, sf_dir).where(F.col("model") == "smoothed_activity_markov")
    return X.density_by_outcome(lf, "p", "y", 40).withColumn("outcome", F.col("outcome").cast("bigint"))


@query("x08_pattern_confusion", with_ctes(f"""
SELECT actual, predicted, rows, {R('rows / sum(rows) OVER (PARTITION BY actual)', 'share')} FROM (
  SELECT actual_active_pattern AS actual, predicted_active_pattern AS predicted, count(*) AS rows
  FROM hb WHERE next_has_order = 1 GROUP BY 1, 2) c""", "hb"))
def x08_pattern_confusion(spark, sf_dir):
    """Row-normalized confusion matrix of the pattern model over active forward rows."""
    h = W.hurdle_baseline(spark, sf_dir).where(F.col("next_has_order") == 1)
    return X.row_normalized_confusion(h, "actual_active_pattern", "predicted_active_pattern")


_LABELS = {"smoothed_activity_markov": "Smoothed Markov", "global_activity_rate": "Global rate"}


_X09_SQL = with_ctes(
    "SELECT CASE model " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items())
    + f" END AS model, log_loss, roc_auc FROM ({binary_metrics_sql('flong')}) m WHERE model IN ("
    + ", ".join(f"'{k}'" for k in _LABELS) + ")", "flong")


@query("x09_baseline_comparison", _X09_SQL)
def x09_baseline_comparison(spark, sf_dir):
    """Baseline-filtered model comparison relabelled through a fixed map."""
    m = M.binary_metrics(forward_long(spark, sf_dir))
    return X.relabel(m, "model", _LABELS).select("model", "log_loss", "roc_auc")


@query("x10_metric_lookup", with_ctes(
    f"SELECT model, 'log_loss' AS metric, log_loss AS value FROM ({binary_metrics_sql('flong')}) m "
    f"WHERE model = 'smoothed_activity_markov'", "flong"))
def x10_metric_lookup(spark, sf_dir):
    """One metric looked up by model in the long metric table (raises when absent)."""
    m = M.binary_metrics(forward_long(spark, sf_dir))
    long = M.stack_metrics(m, ["model"], ["log_loss", "roc_auc", "brier"])
    return X.metric_lookup(long, model="smoothed_activity_markov", metric="log_loss")


_STRATA = [n for n, _ in PILOT_TARGETS] + ["capacity_fill"]


@query("x11_strata_summary", with_ctes(
    "SELECT s.sampling_stratum, coalesce(c.cases, 0) AS cases, coalesce(c.cases, 0) > 0 AS populated FROM (VALUES "
    + ", ".join(f"('{s}')" for s in _STRATA) + f") s(sampling_stratum) LEFT JOIN "
    f"(SELECT sampling_stratum, count(*) AS cases FROM {ALLOC} GROUP BY 1) c USING (sampling_stratum)", ALLOC))
def x11_strata_summary(spark, sf_dir):
    """X11: populated / unpopulated pilot strata."""
    strata = spark.createDataFrame([(s,) for s in _STRATA], "sampling_stratum string")
    c = W.pilot(spark, sf_dir).groupBy("sampling_stratum").agg(F.count(F.lit(1)).alias("cases"))
    j = strata.join(c, "sampling_stratum", "left").withColumn("cases", F.coalesce("cases", F.lit(0)))
    return j.withColumn("populated", F.col("cases") > 0)


def _long_e01_sql():
    cols = ["rows", "activity_rate", "accuracy", "balanced_accuracy", "f1", "roc_auc", "average_precision", "log_loss", "brier"]
    inner = binary_metrics_sql("flong")
    return " UNION ALL ".join(f"SELECT model, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM ({inner}) m{i}"
                              for i, c in enumerate(cols))


_E01_COLS = ["rows", "activity_rate", "accuracy", "balanced_accuracy", "f1", "roc_auc", "average_precision", "log_loss", "brier"]


@query("snk3_metrics_json", with_ctes(_long_e01_sql(), "flong"))
def snk3_metrics_json(spark, sf_dir):
    """SNK3: long metric table written as JSON (non-finite -> NULL) and read back."""
    long = M.stack_metrics(M.binary_metrics(forward_long(spark, sf_dir)), ["model"], _E01_COLS)
    path = stage_path(spark, "metrics_json", sf_dir)
    sinks.write_metrics_json(long, path)
    return spark.read.schema("model string, metric string, value double").json(path)


@query("snk4_compiled_evidence", with_ctes(
    "SELECT 'data_package' AS section, 'customer_month_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM facts "
    "UNION ALL SELECT 'data_package', 'customers', CAST(count(DISTINCT customer_public_id) AS DOUBLE) FROM facts "
    "UNION ALL SELECT 'data_package', 'model_end_month', CAST(max(year(transaction_month) * 100 + month(transaction_month)) AS DOUBLE) FROM facts "
    f"UNION ALL SELECT 'activity_forward', metric, value FROM ({_long_e01_sql()}) a WHERE model = 'smoothed_activity_markov' "
    "UNION ALL SELECT 'operational_layer', 'pilot_rows', CAST(count(*) AS DOUBLE) FROM " + ALLOC,
    "facts", "flong", ALLOC))
def snk4_compiled_evidence(spark, sf_dir):
    """SNK4: one evidence record (long form): package counts computed from the panel, the
    operational model's forward metrics, and the pilot size."""
    from caseload.plans import inputs as I
    f = I.facts(spark, sf_dir)
    pkg = f.agg(F.count(F.lit(1)).cast("double").alias("customer_month_rows"),
                F.countDistinct("customer_public_id").cast("double").alias("customers"),
                F.max(F.year("transaction_month") * 100 + F.month("transaction_month")).cast("double").alias("model_end_month"))
    pkg = M.stack_metrics(pkg, [], ["customer_month_rows", "customers", "model_end_month"]).withColumn("section", F.lit("data_package"))
    act = M.stack_metrics(M.binary_metrics(forward_long(spark, sf_dir)), ["model"], _E01_COLS).where(
        F.col("model") == "smoothed_activity_markov").drop("model").withColumn("section", F.lit("activity_forward"))
    ops = W.pilot(spark, sf_dir).agg(F.count(F.lit(1)).cast("double").alias("pilot_rows"))
    ops = M.stack_metrics(ops, [], ["pilot_rows"]).withColumn("section", F.lit("operational_layer"))
    return pkg.unionByName(act).unionByName(ops).select("section", "metric", "value")
