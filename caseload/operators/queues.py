"""Capacity-bounded monthly queues, set comparison and the validated lens join (Q1-Q12).

Top-K plans: ``row_number() <= K`` directly over the window lets Spark insert a
``WindowGroupLimit`` (partial top-K before the shuffle). The selected keys are at most
K x months rows -- a proven bound -- so joining them back as flags may broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.config import HURDLE_DIRECTIONS

CUR = "customer_public_id"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def monthly_topk_ranks(df: DataFrame, score: str, k_max: int, *, eligible=None,
                       month: str = "transaction_month", key: str = CUR,
                       rank_name: str = "queue_rank") -> DataFrame:
    """Q1 core: (key, month, rank) for rank <= k_max; score desc, NULL last, key asc."""
    src = df if eligible is None else df.where(_col(eligible))
    w = Window.partitionBy(month).orderBy(F.desc_nulls_last(score), F.asc(key))
    ranked = src.select(key, month, F.row_number().over(w).alias(rank_name))
    return ranked.where(F.col(rank_name) <= k_max)


def attach_topk_flags(df: DataFrame, score: str, capacities, prefix: str, *, eligible=None,
                      month: str = "transaction_month", key: str = CUR, keep=None) -> DataFrame:
    """Q1/Q2: one rank per strategy, then ``{prefix}_top_{K}`` flags for every capacity. ``keep`` writes the selected keys
    and reads them back, so that who reads the flags does not rank again."""
    caps = tuple(capacities)
    rname = f"_{prefix}_rank"
    ranks = monthly_topk_ranks(df, score, max(caps), eligible=eligible, month=month, key=key,
                               rank_name=rname)
    ranks = ranks if keep is None else keep(ranks)
    out = df.join(F.broadcast(ranks), [key, month], "left")
    for k in caps:
        out = out.withColumn(f"{prefix}_top_{k}", F.coalesce(F.col(rname) <= k, F.lit(False)))
    return out.drop(rname)


def waterfill_ranks(df: DataFrame, score: str, direction: str, capacity: int, *,
                    month: str = "target_month", key: str = CUR,
                    directions=HURDLE_DIRECTIONS, cap_at_month_size: bool = True) -> DataFrame:
    """Q3/Q4: water-fill across directions with unused quota redistributed.

    Closed form of the iterative quota loop: rank r within (month, direction); the loop takes
    rows round-robin by r with the fixed direction order, so the selection is
    ``row_number() over (partition by month order by r, direction_index) <= K``.
    Prefilter r <= K keeps each month's second window to at most K x directions rows.
    Returns (key, month, direction, within_rank, fill_rank) of the selected rows.
    """
    idx = F.lit(None).cast("int")
    for i, d in enumerate(directions):
        idx = F.when(F.col(direction) == d, F.lit(i)).otherwise(idx)
    pool = df.where(F.col(direction).isin(list(directions))).withColumn("_dir_idx", idx)
    w1 = Window.partitionBy(month, direction).orderBy(F.desc_nulls_last(score), F.asc(key))
    r = pool.select(key, month, direction, "_dir_idx", F.row_number().over(w1).alias("within_rank"))
    r = r.where(F.col("within_rank") <= capacity)
    w2 = Window.partitionBy(month).orderBy("within_rank", "_dir_idx")
    r = r.select(key, month, direction, "within_rank", F.row_number().over(w2).alias("fill_rank"))
    return r.where(F.col("fill_rank") <= capacity).drop()


def attach_waterfill_flags(df: DataFrame, score: str, direction: str, capacities, prefix: str, *,
                           eligible=None, month: str = "target_month", key: str = CUR) -> DataFrame:
    """Flags ``{prefix}_top_{K}`` for several capacities from one pair of windows.

    The round-robin order does not depend on K, so ranking once with K_max and cutting at
    each K is exact (K is capped at the month's eligible rows implicitly: fewer rows exist).
    """
    caps = tuple(capacities)
    src = df if eligible is None else df.where(_col(eligible))
    sel = waterfill_ranks(src, score, direction, max(caps), month=month, key=key)
    sel = sel.select(key, month, F.col("fill_rank").alias("_wf_rank"))
    out = df.join(F.broadcast(sel), [key, month], "left")
    for k in caps:
        out = out.withColumn(f"{prefix}_top_{k}", F.coalesce(F.col("_wf_rank") <= k, F.lit(False)))
    return out.drop("_wf_rank")


def jaccard(left, right) -> Column:
    """Q6 aggregate: |L and R| / |L or R|; NULL for an empty union."""
    l, r = _col(left), _col(right)
    inter = F.sum(F.when(l & r, 1).otherwise(0))
    union = F.sum(F.when(l | r, 1).otherwise(0))
    return F.when(union > 0, inter / union)


def validated_inner_join(left: DataFrame, right: DataFrame, left_keys, right_keys) -> DataFrame:
    """Q5: inner equi-join, checked one-to-one on both sides (raises otherwise)."""
    for side, keys, name in ((left, left_keys, "left"), (right, right_keys, "right")):
        dup = side.groupBy(*keys).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"Merge keys are not unique in {name} dataset; not a one-to-one merge")
    cond = [left[a] == right[b] for a, b in zip(left_keys, right_keys)]
    return left.join(right, cond, "inner")
