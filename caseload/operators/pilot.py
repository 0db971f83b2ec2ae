"""Stratified blinded pilot (P1-P7) on the latest month of the merged lenses.

The draw is one pass over the latest month. Each stratum keeps the rows of smallest seeded md5, as many as
its target and all earlier targets together (so many can be taken before its turn), by partial top-k windows.
The few hundred rows kept are then chosen serially, stratum by stratum, in one expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseload.config import CASE_TOKEN_PREFIX, PILOT_TARGETS, RANDOM_STATE

CUR = "customer_public_id"
MONTH = "transaction_month"


def deterministic_sample(pool: DataFrame, n: int, seed: int, partition_cols=()) -> DataFrame:
    """N rows without replacement (whole pool when smaller), ordered by md5(seed|customer|month)."""
    order = Window.partitionBy(*partition_cols).orderBy(_draw_key(seed), F.col(CUR))
    return pool.withColumn("_draw", F.row_number().over(order)).where(F.col("_draw") <= n).drop("_draw")


def strata_masks(latest: DataFrame, cap: int) -> dict:
    ch, hu = F.col(f"channel_top_{cap}"), F.col(f"hurdle_top_{cap}")
    co, hy = F.col(f"company_division_top_{cap}"), F.col(f"hybrid_top_{cap}")
    return {
        "agreement_core": ch & hu,
        "channel_only": ch & ~hu,
        "hurdle_only": hu & ~ch,
        "peer_definition_disagreement": (ch != co) | (ch != hy),
        "background": ~(ch | hu | co | hy),
    }


def latest_month(merged: DataFrame) -> DataFrame:
    """Q11: rows of the latest month (one-row max, broadcast)."""
    mx = merged.agg(F.max(MONTH).alias("_latest"))
    return merged.join(F.broadcast(mx), F.col(MONTH) == F.col("_latest")).drop("_latest")


def _draw_key(seed: int):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(CUR), F.date_format(MONTH, "yyyy-MM-dd")))


def stratified_draw(pool: DataFrame, masks: dict, targets, fill: str = "capacity_fill") -> DataFrame:
    """``pool`` (one row a customer) cut to the drawn rows, with ``sampling_stratum``.

    Stratum after stratum takes the rows of smallest seeded md5 among its own whose customer no earlier one took,
    up to its target; the fill takes from all rows until the targets' sum is reached. Stratum i can lose at most
    the sum of the earlier targets, so its first ``target + earlier targets`` rows decide it; the fill's first
    ``sum of targets`` rows decide the fill. Those rows, a number fixed by the targets, are chosen in one task."""
    names, sizes = [n for n, _ in targets] + [fill], [t for _, t in targets]
    total = sum(sizes)
    depths = [sum(sizes[:i + 1]) for i in range(len(sizes))] + [total]
    entry = lambda i, seed: F.struct(F.lit(i).alias("place"), _draw_key(seed).alias("key"))
    entries = [F.when(masks[n], entry(i, RANDOM_STATE + i)) for i, n in enumerate(names[:-1])] + [entry(len(sizes), RANDOM_STATE + 99)]
    rows = pool.select(F.struct(*pool.columns).alias("row"), F.explode(F.array_compact(F.array(*entries))).alias("entry"))
    nth = F.row_number().over(Window.partitionBy("entry.place").orderBy("entry.key", f"row.{CUR}"))
    kept = rows.withColumn("nth", nth).where((F.col("nth") <= max(depths)) & (F.col("nth") <= F.get(F.array(*map(F.lit, depths)), F.col("entry.place"))))
    listed = kept.agg(F.sort_array(F.collect_list(F.struct(F.col("entry.place").alias("place"), "nth", "row"))).alias("listed"))

    def choose(taken, x):
        used = F.coalesce(F.exists(taken, lambda y: y["row"][CUR] == x["row"][CUR]), F.lit(False))
        own = F.size(F.filter(taken, lambda y: y["place"] == x["place"]))
        room = F.when(x["place"] < len(sizes), own < F.get(F.array(*map(F.lit, [*sizes, 0])), x["place"])).otherwise(F.size(taken) < total)
        return F.when(room & ~used, F.concat(taken, F.array(x))).otherwise(taken)

    drawn = listed.select(F.explode(F.aggregate("listed", F.slice("listed", 1, 0), choose)).alias("x"))
    return drawn.select("x.row.*", F.get(F.array(*map(F.lit, names)), F.col("x.place")).alias("sampling_stratum"))


def pilot_allocation(merged: DataFrame, cap: int, targets=PILOT_TARGETS, prefix: str = CASE_TOKEN_PREFIX) -> DataFrame:
    """Sequential strata without customer reuse, capacity fill, case tokens, inclusion
    probabilities (pool sizes before cross-stratum exclusion, as specified).

    Two scans: the month and the flags for the latest month and its pool sizes (a row a month, the last one is
    broadcast), then the draw. ``merged`` holds one row a customer and month."""
    pools = {n: f"_pool_{n}" for n, _ in targets}
    masks = strata_masks(merged, cap)
    months = merged.groupBy(F.col(MONTH).alias("_latest")).agg(
        *[F.sum(F.when(masks[n], 1).otherwise(0)).alias(c) for n, c in pools.items()], F.count(F.lit(1)).alias("_latest_rows"))
    latest = merged.join(F.broadcast(months.orderBy(F.desc_nulls_last("_latest")).limit(1)), F.col(MONTH) == F.col("_latest"))
    alloc = stratified_draw(latest, masks, targets)
    filled = sum(F.least(F.col(pools[n]), F.lit(t)) for n, t in targets)
    total = sum(t for _, t in targets)
    at_most_one = lambda part, whole: F.least(F.lit(1.0), part / F.greatest(F.lit(1), whole))
    probability = at_most_one(F.greatest(F.lit(0), F.lit(total) - filled), F.col("_latest_rows") - filled)
    for n, t in targets:
        probability = F.when(F.col("sampling_stratum") == n, at_most_one(F.lit(float(t)), F.col(pools[n]))).otherwise(probability)
    token = F.substring(F.sha2(F.concat_ws("|", F.lit(prefix), F.col(CUR), F.date_format(MONTH, "yyyy-MM")), 256), 1, 16)
    return alloc.withColumn("inclusion_probability", probability).withColumn("case_id", token).drop("_latest", "_latest_rows", *pools.values())


def exact_inclusion(merged: DataFrame, alloc: DataFrame, cap: int, targets=PILOT_TARGETS) -> DataFrame:
    """P5, exact variant: per stratum the pool that was left when it was drawn, cases drawn, drawn / pool.

    ``alloc`` has at most the pilot's size of rows; a row is out of a pool if an earlier stratum took its customer."""
    order = {name: i for i, (name, _) in enumerate(targets)}
    place = F.coalesce(*[F.when(F.col("sampling_stratum") == n, F.lit(i)) for n, i in order.items()], F.lit(len(order)))
    rows = latest_month(merged).join(F.broadcast(alloc.select(CUR, place.alias("place"))), CUR, "left")
    masks = {**{n: m for n, m in strata_masks(rows, cap).items() if n in order}, "capacity_fill": F.lit(True)}
    order["capacity_fill"] = len(order)
    open_at = lambda n: F.coalesce(F.col("place") >= order[n], F.lit(True))
    sums = rows.agg(*[F.sum(F.when(m & open_at(n), 1).otherwise(0)).alias(f"pool_{n}") for n, m in masks.items()],
                    *[F.sum(F.when(F.col("place") == order[n], 1).otherwise(0)).alias(f"drawn_{n}") for n in masks])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("sampling_stratum"), F.col(f"pool_{n}").alias("pool"), F.col(f"drawn_{n}").alias("drawn")) for n in masks]))
    share = F.when(F.col("pool") > 0, F.col("drawn") / F.col("pool")).otherwise(0.0)
    return sums.select(each.alias("x")).select("x.*").withColumn("exact_inclusion_probability", share)


def allocation_key(alloc: DataFrame, cap: int) -> DataFrame:
    """P6 (private side): case key with stratum, probability and the four lens flags."""
    return alloc.select("case_id", CUR, MONTH, "sampling_stratum", "inclusion_probability",
                        f"channel_top_{cap}", f"company_division_top_{cap}", f"hybrid_top_{cap}", f"hurdle_top_{cap}")


def blinded_sample(alloc: DataFrame) -> DataFrame:
    """P6 (reviewer side): no customer id, no stratum; empty response fields."""
    return alloc.select("case_id", MONTH, "hurdle_direction",
                        F.lit("").alias("review_outcome"), F.lit(None).cast("double").alias("review_effort_minutes"),
                        F.lit("").alias("reviewer_notes"))


def composition(alloc: DataFrame) -> DataFrame:
    """Cases per stratum."""
    return alloc.groupBy("sampling_stratum").agg(F.count(F.lit(1)).alias("cases"))
