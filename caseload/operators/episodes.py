"""Alert episodes (E-A1..E-A8): gaps-and-islands over monthly flags per customer.

Flagged rows per customer are at most the number of panel months, so the customer window is
bounded; summaries are a plain grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseload.functions.exprs import month_number

CUR = "customer_public_id"
MONTH = "transaction_month"


def episode_numbers(flags: DataFrame) -> DataFrame:
    """E-A1: new episode on a month gap != 1 or a direction change (first row always new)."""
    work = flags.where(F.col("flag"))
    w = Window.partitionBy(CUR).orderBy(MONTH)
    mn = month_number(MONTH)
    gap = mn - F.lag(mn).over(w)
    dchange = ~F.col("signal_direction").eqNullSafe(F.lag("signal_direction").over(w))
    new = F.coalesce(gap != 1, F.lit(True)) | dchange
    work = work.withColumn("_new", new.cast("int"))
    return work.withColumn("episode_number",
                           F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_new")


def episode_table(flags: DataFrame, lens: str) -> DataFrame:
    """E-A1..E-A4: summary per (customer, episode) with status and hashed episode id."""
    work = episode_numbers(flags)
    summary = work.groupBy(CUR, "episode_number").agg(
        F.min(MONTH).alias("first_month"),
        F.max(MONTH).alias("last_month"),
        F.count(F.lit(1)).alias("months_flagged"),
        F.max("score").alias("max_score"),
        F.max_by("signal_direction", MONTH).alias("signal_direction"),
    )
    return summary.select(
        CUR, "episode_number", "first_month", "last_month", "months_flagged", "max_score",
        "signal_direction", F.lit(lens).alias("lens"),
        F.when(F.col("months_flagged") == 1, "new").otherwise("ongoing").alias("episode_status"),
        F.substring(F.sha2(F.concat_ws("|", F.lit(lens), F.col(CUR), F.col("episode_number").cast("string")), 256),
                    1, 16).alias("episode_id"),
    )


def episode_counts(episodes: DataFrame) -> DataFrame:
    """E-A6: episodes by lens x status."""
    return episodes.groupBy("lens", "episode_status").agg(F.count(F.lit(1)).alias("episodes"))


def repeat_months_avoided(episodes: DataFrame) -> DataFrame:
    """E-A7: sum(months flagged) - episodes, per lens."""
    return episodes.groupBy("lens").agg(
        (F.sum("months_flagged") - F.count(F.lit(1))).cast("bigint").alias("repeat_customer_months_avoided"))


def episode_duration(episodes: DataFrame) -> DataFrame:
    """E-A8: count and mean months by lens x status."""
    return episodes.groupBy("lens", "episode_status").agg(
        F.count(F.lit(1)).alias("episodes"), F.avg("months_flagged").alias("mean_months_flagged"))
