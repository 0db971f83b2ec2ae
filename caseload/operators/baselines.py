"""Baselines, pattern labels and chronological folds (M1-M6). Fit on train only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseload.session import scratch_table


def markov_table(train: DataFrame) -> DataFrame:
    """M1 fit: P(next=1 | current) = (sum+1)/(count+2) for states 0 and 1 (absent state -> 1/2)."""
    spark = train.sparkSession
    states = spark.range(2).select(F.col("id").cast("int").alias("current_has_order"))
    agg = train.groupBy("current_has_order").agg(F.sum("next_has_order").alias("s"), F.count(F.lit(1)).alias("n"))
    return states.join(agg, "current_has_order", "left").select(
        "current_has_order",
        ((F.coalesce("s", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)).cast("double").alias("p_markov"))


def global_rate(train: DataFrame) -> DataFrame:
    """M2 fit: one-row train activity rate."""
    return train.agg(F.avg(F.col("next_has_order").cast("double")).alias("p_global"))


def apply_baselines(rows: DataFrame, train: DataFrame) -> DataFrame:
    """M1/M2 apply: broadcast the 2-row state table and the 1-row global rate (proven sizes);
    an unseen state falls back to the train mean."""
    g = global_rate(train)
    return (rows.join(F.broadcast(markov_table(train)), "current_has_order", "left")
                .crossJoin(F.broadcast(g))
                .withColumn("p_markov", F.coalesce("p_markov", "p_global")))


def pattern_thresholds(panel: DataFrame) -> DataFrame:
    """M3: exact train-active quantiles (linear interpolation): discount p90, breadth p75, orders p75."""
    from caseload.operators.ranking import exact_percentiles
    ta = panel.where((F.col("data_split") == "train") & (F.col("next_has_order") == 1))
    # distributed exact quantiles: the train-active rows are one unbounded group; the three measures share the passes
    wanted = {"discount_p90": ("next_discount_rate", "p90"), "breadth_p75": ("next_distinct_product_count", "p75"), "orders_p75": ("next_order_count", "p75")}
    long = ta.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("v")) for n, (c, _) in wanted.items()])).alias("x")).select("x.*")
    found = exact_percentiles(long, "v", {"p75": 0.75, "p90": 0.9}, by=["name"])
    return found.agg(*[F.max(F.when(F.col("name") == n, F.col(q))).alias(n) for n, (_, q) in wanted.items()])


def pattern_label(thr_prefix: str = "") -> F.Column:
    """M4: ordered label; precedence return_heavy > discount_heavy > broad > multi_order > typical."""
    t = lambda c: F.col(f"{thr_prefix}{c}")
    return (F.when(F.col("next_return_line_rate") > 0, "return_heavy")
             .when(F.col("next_discount_rate") > t("discount_p90"), "discount_heavy")
             .when(F.col("next_distinct_product_count") >= t("breadth_p75"), "broad")
             .when(F.col("next_order_count") >= t("orders_p75"), "multi_order")
             .otherwise("typical"))


def with_pattern_labels(panel: DataFrame) -> DataFrame:
    return panel.crossJoin(F.broadcast(scratch_table(pattern_thresholds(panel)))).withColumn("next_active_pattern", pattern_label())


def month_blocks(panel: DataFrame, mask, n_folds: int = 4, month: str = "target_month") -> DataFrame:
    """M5: distinct masked months -> n+1 contiguous blocks (remainder to the front blocks,
    like ``array_split``); n shrinks to months-1 when there are too few months.
    The window runs over distinct months only (a few hundred rows at most)."""
    months = panel.where(mask).select(month).distinct()
    cnt = months.agg(F.count(F.lit(1)).alias("m"))
    nb = F.when(F.col("m") < n_folds + 1, F.greatest(F.lit(1), F.col("m") - 1)).otherwise(F.lit(n_folds)) + 1
    w = Window.orderBy(month)
    rn = F.row_number().over(w) - 1  # 0-based position
    m = months.crossJoin(F.broadcast(cnt)).select(month, rn.alias("pos"), F.col("m"), nb.alias("blocks"))
    # array_split: first (m % b) blocks have size q+1, the rest q, with q = m div b
    q = F.floor(F.col("m") / F.col("blocks"))
    r = F.col("m") - q * F.col("blocks")
    big = r * (q + 1)
    block = F.when(F.col("pos") < big, F.floor(F.col("pos") / (q + 1))).otherwise(r + F.floor((F.col("pos") - big) / q))
    return m.select(month, (block + 1).cast("bigint").alias("block"), (F.col("blocks") - 1).cast("bigint").alias("n_folds"))


def expanding_folds(panel: DataFrame, mask, n_folds: int = 4, month: str = "target_month") -> DataFrame:
    """M5: (fold, role, month) assignments; fold i trains on blocks 1..i, validates on block i+1."""
    blocks = month_blocks(panel, mask, n_folds, month)
    spark: SparkSession = panel.sparkSession
    folds = spark.range(1, n_folds + 1).select(F.col("id").alias("fold"))
    j = blocks.crossJoin(F.broadcast(folds)).where(F.col("fold") <= F.col("n_folds"))
    role = F.when(F.col("block") <= F.col("fold"), "train").when(F.col("block") == F.col("fold") + 1, "validation")
    return j.select("fold", role.alias("role"), month).where(F.col("role").isNotNull())


def fold_boundaries(panel: DataFrame, mask, n_folds: int = 4, month: str = "target_month") -> DataFrame:
    """M6: per fold, min/max month and row counts of train and validation (no customer ids)."""
    folds = expanding_folds(panel, mask, n_folds, month)
    rows = panel.where(mask).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    j = folds.join(F.broadcast(rows), month)
    tr, va = F.col("role") == "train", F.col("role") == "validation"
    out = j.groupBy("fold").agg(
        F.min(F.when(tr, F.col(month))).alias("train_start"), F.max(F.when(tr, F.col(month))).alias("train_end"),
        F.min(F.when(va, F.col(month))).alias("validation_start"), F.max(F.when(va, F.col(month))).alias("validation_end"),
        F.sum(F.when(tr, F.col("n")).otherwise(0)).cast("bigint").alias("train_rows"),
        F.sum(F.when(va, F.col("n")).otherwise(0)).cast("bigint").alias("validation_rows"))
    return out.where((F.col("train_rows") > 0) & (F.col("validation_rows") > 0))


def pattern_prior(train_labeled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Class-prior stand-in for the Stage-2 pattern model on train-active rows: class shares
    (at most five rows) and the majority class (ties by class name)."""
    ta = train_labeled.where(F.col("next_has_order") == 1)
    cnt = ta.groupBy(F.col("next_active_pattern").alias("pattern_class")).agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.agg(F.sum("n").alias("_t"))
    shares = cnt.crossJoin(tot).select("pattern_class", (F.col("n") / F.col("_t")).alias("pattern_share"))
    majority = shares.orderBy(F.desc("pattern_share"), F.asc("pattern_class")).limit(1).select(
        F.col("pattern_class").alias("majority_pattern"))
    return shares, majority
