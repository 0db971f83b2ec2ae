"""Registered queries: operational layer (Q3-Q5, Q8-Q11, E-A1..E-A8, P1-P7) and sinks (SNK1-SNK2, SRC2, SRC4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import CAPACITIES, CASE_TOKEN_PREFIX, PILOT_TARGETS
from caseload.operators import episodes as EP
from caseload.operators import pilot as PL
from caseload.operators.queues import jaccard
from caseload.plans import workflows as W
from caseload.plans.oracle import episode_sql, merged_cte, pilot_ctes, waterfill_cte, with_ctes
from caseload.plans.q_s2 import PF
from caseload.plans.registry import R, query
from caseload.plans.stages import stage_path
from caseload.sources import sinks

HQ = waterfill_cte("hq", "hb", CAPACITIES)
MG = merged_cte(PF, HQ, CAPACITIES)
CAP = CAPACITIES[1]
ALLOC = pilot_ctes(MG, CAP, PILOT_TARGETS, CASE_TOKEN_PREFIX)
HFLAGS = [f"hurdle_top_{k}" for k in CAPACITIES]


@query("q03_q04_waterfill_queue", with_ctes(
    f"SELECT customer_public_id, target_month, hurdle_direction, {R('hurdle_surprisal_score')}, {', '.join(HFLAGS)} "
    f"FROM {HQ} WHERE hurdle_top_{max(CAPACITIES)}", HQ))
def q03_q04_waterfill_queue(spark, sf_dir):
    """Q3/Q4: direction-fair monthly water-fill queue (rows selected at the largest capacity)."""
    caps = CAPACITIES
    q = W.hurdle_queue(spark, sf_dir)
    return q.where(F.col(f"hurdle_top_{max(caps)}")).select(
        "customer_public_id", "target_month", "hurdle_direction", "hurdle_surprisal_score",
        *[f"hurdle_top_{k}" for k in caps])


_MG_COLS = ["customer_public_id", "transaction_month", "target_month", "hurdle_direction",
            "channel_s2_score", "hurdle_surprisal_score", f"channel_top_{CAP}", f"hurdle_top_{CAP}"]


@query("q05_lens_join", with_ctes(
    "SELECT customer_public_id, transaction_month, target_month, hurdle_direction, "
    f"{R('channel_s2_score')}, {R('hurdle_surprisal_score')}, channel_top_{CAP}, hurdle_top_{CAP} FROM {MG}", MG))
def q05_lens_join(spark, sf_dir):
    """Q5: validated one-to-one inner join of both lenses (month = target month)."""
    cap = CAPACITIES[1]
    return W.merged_lenses(spark, sf_dir).select(*_MG_COLS[:6], f"channel_top_{cap}", f"hurdle_top_{cap}")


_Q8 = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS capacity_per_month, "
    f"{R(f'CASE WHEN sum(CASE WHEN channel_top_{k} OR hurdle_top_{k} THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN channel_top_{k} AND hurdle_top_{k} THEN 1 ELSE 0 END) / sum(CASE WHEN channel_top_{k} OR hurdle_top_{k} THEN 1 ELSE 0 END) END', 'channel_vs_hurdle_jaccard')}, "
    f"CAST(sum(CASE WHEN channel_top_{k} THEN 1 ELSE 0 END) AS BIGINT) AS channel_rows, "
    f"CAST(sum(CASE WHEN hurdle_top_{k} THEN 1 ELSE 0 END) AS BIGINT) AS hurdle_rows, "
    f"CAST(sum(CASE WHEN channel_top_{k} AND hurdle_top_{k} THEN 1 ELSE 0 END) AS BIGINT) AS overlap_rows FROM {MG}"
    for k in CAPACITIES)


@query("q08_lens_overlap", with_ctes(_Q8, MG))
def q08_lens_overlap(spark, sf_dir):
    """Q6/Q8: lens overlap per capacity (Jaccard, rows per lens, shared rows)."""
    m = W.merged_lenses(spark, sf_dir)
    out = None
    for k in CAPACITIES:
        a, b = F.col(f"channel_top_{k}"), F.col(f"hurdle_top_{k}")
        cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
        row = m.agg(F.lit(k).cast("bigint").alias("capacity_per_month"), jaccard(a, b).alias("channel_vs_hurdle_jaccard"),
                    cnt(a).alias("channel_rows"), cnt(b).alias("hurdle_rows"), cnt(a & b).alias("overlap_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def _strata_counts_sql():
    c, h, co, hy = (f"{s}_top_{CAP}" for s in ("channel", "hurdle", "company_division", "hybrid"))
    return f"""
SELECT transaction_month,
  CAST(sum(CASE WHEN {c} AND {h} THEN 1 ELSE 0 END) AS BIGINT) AS agreement_core,
  CAST(sum(CASE WHEN {c} AND NOT {h} THEN 1 ELSE 0 END) AS BIGINT) AS channel_only,
  CAST(sum(CASE WHEN {h} AND NOT {c} THEN 1 ELSE 0 END) AS BIGINT) AS hurdle_only,
  CAST(sum(CASE WHEN ({c} <> {co}) OR ({c} <> {hy}) THEN 1 ELSE 0 END) AS BIGINT) AS peer_definition_disagreement,
  CAST(sum(CASE WHEN NOT ({c} OR {h} OR {co} OR {hy}) THEN 1 ELSE 0 END) AS BIGINT) AS background
FROM {MG} GROUP BY transaction_month"""


@query("q09_set_algebra_strata", with_ctes(_strata_counts_sql(), MG))
def q09_set_algebra_strata(spark, sf_dir):
    """Q9: agreement / only / disagreement / background flag algebra, counted per month."""
    m = W.merged_lenses(spark, sf_dir)
    masks = PL.strata_masks(m, CAPACITIES[1])
    return m.groupBy("transaction_month").agg(
        *[F.sum(F.when(v, 1).otherwise(0)).cast("bigint").alias(k) for k, v in masks.items()])


def _flags_sql(lens):
    if lens == "s2_channel":
        return (f"SELECT customer_public_id, transaction_month, channel_s2_score AS score, channel_top_{CAP} AS flag, "
                f"'baseline_deviation' AS signal_direction FROM {MG}")
    return (f"SELECT customer_public_id, transaction_month, hurdle_surprisal_score AS score, hurdle_top_{CAP} AS flag, "
            f"hurdle_direction AS signal_direction FROM {MG}")


_EPISODES = f"({episode_sql(_flags_sql('s2_channel'), 's2_channel')}) UNION ALL ({episode_sql(_flags_sql('hurdle_cadence'), 'hurdle_cadence')})"


@query("q10_alert_episodes", with_ctes(f"SELECT * FROM ({_EPISODES}) e", MG))
def q10_alert_episodes(spark, sf_dir):
    """E-A1..E-A5 + Q10: both lenses' episodes at the middle capacity, stacked."""
    return W.episodes(spark, sf_dir)


@query("ea6_episode_counts", with_ctes(
    f"SELECT lens, episode_status, count(*) AS episodes FROM ({_EPISODES}) e GROUP BY 1, 2", MG))
def ea6_episode_counts(spark, sf_dir):
    """E-A6: episodes by lens x status."""
    return EP.episode_counts(W.episodes(spark, sf_dir))


@query("ea7_repeat_months_avoided", with_ctes(
    f"SELECT lens, CAST(sum(months_flagged) - count(*) AS BIGINT) AS repeat_customer_months_avoided "
    f"FROM ({_EPISODES}) e GROUP BY lens", MG))
def ea7_repeat_months_avoided(spark, sf_dir):
    """E-A7: repeat customer-months avoided per lens."""
    return EP.repeat_months_avoided(W.episodes(spark, sf_dir))


@query("ea8_episode_duration", with_ctes(
    f"SELECT lens, episode_status, count(*) AS episodes, {R('avg(months_flagged)', 'mean_months_flagged')} "
    f"FROM ({_EPISODES}) e GROUP BY 1, 2", MG))
def ea8_episode_duration(spark, sf_dir):
    """E-A8: episode count and mean duration by lens x status."""
    return EP.episode_duration(W.episodes(spark, sf_dir))


@query("q11_latest_month", with_ctes(
    f"SELECT transaction_month, count(*) AS rows FROM {MG} "
    f"WHERE transaction_month = (SELECT max(transaction_month) FROM {MG}) GROUP BY 1", MG))
def q11_latest_month(spark, sf_dir):
    """Q11: the latest month and its rows."""
    return PL.latest_month(W.merged_lenses(spark, sf_dir)).groupBy("transaction_month").agg(
        F.count(F.lit(1)).alias("rows"))


_KEY_COLS = ["case_id", "customer_public_id", "transaction_month", "sampling_stratum",
             R("inclusion_probability"), f"channel_top_{CAP}", f"company_division_top_{CAP}",
             f"hybrid_top_{CAP}", f"hurdle_top_{CAP}"]


@query("p02_p05_pilot_allocation", with_ctes(f"SELECT {', '.join(_KEY_COLS)} FROM {ALLOC}", ALLOC))
def p02_p05_pilot_allocation(spark, sf_dir):
    """P1-P5 + Q12: stratified pilot with sequential customer exclusion, fill, tokens, probabilities."""
    return PL.allocation_key(W.pilot(spark, sf_dir), CAPACITIES[1])


_BLIND_SQL = with_ctes(
    f"SELECT case_id, transaction_month, hurdle_direction, '' AS review_outcome, "
    f"CAST(NULL AS DOUBLE) AS review_effort_minutes, '' AS reviewer_notes FROM {ALLOC}", ALLOC)


@query("p06_blinded_sample", _BLIND_SQL)
def p06_blinded_sample(spark, sf_dir):
    """Reviewer-facing blinded sample (no customer id, no stratum)."""
    return PL.blinded_sample(W.pilot(spark, sf_dir))


@query("p07_pilot_composition", with_ctes(
    f"SELECT sampling_stratum, count(*) AS cases FROM {ALLOC} GROUP BY 1", ALLOC))
def p07_pilot_composition(spark, sf_dir):
    """Cases per stratum."""
    return PL.composition(W.pilot(spark, sf_dir))


@query("snk2_src4_blinded_csv", _BLIND_SQL)
def snk2_src4_blinded_csv(spark, sf_dir):
    """SNK2 + SRC4: blinded sample written as CSV with a header, read back with an explicit schema."""
    path = stage_path(spark, "blinded_csv", sf_dir)
    sinks.write_csv(PL.blinded_sample(W.pilot(spark, sf_dir)), path)
    return sinks.read_blinded_csv(spark, path)


@query("snk1_src2_episode_parquet", with_ctes(f"SELECT * FROM ({_EPISODES}) e", MG))
def snk1_src2_episode_parquet(spark, sf_dir):
    """SNK1 + SRC2: episodes written as parquet partitioned by lens and re-scanned."""
    path = stage_path(spark, "episodes_parquet", sf_dir)
    sinks.write_parquet(W.episodes(spark, sf_dir), path, partition_by=("lens",))
    return spark.read.parquet(path).select(*W.episodes(spark, sf_dir).columns)


_P8_SQL = with_ctes(f"""
SELECT 'episode_counts' AS section, lens || '|' || episode_status AS key, 'episodes' AS metric,
       CAST(count(*) AS DOUBLE) AS value FROM ({_EPISODES}) e GROUP BY lens, episode_status
UNION ALL
SELECT 'repeat_customer_months_avoided', lens, 'months', CAST(sum(months_flagged) - count(*) AS DOUBLE)
FROM ({_EPISODES}) e GROUP BY lens
UNION ALL
SELECT 'pilot_strata', sampling_stratum, 'cases', CAST(count(*) AS DOUBLE) FROM {ALLOC} GROUP BY sampling_stratum
UNION ALL
""" + " UNION ALL ".join(
    f"SELECT 'capacity_overlap', '{k}', 'channel_vs_hurdle_jaccard', "
    f"{R(f'CASE WHEN sum(CASE WHEN channel_top_{k} OR hurdle_top_{k} THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN channel_top_{k} AND hurdle_top_{k} THEN 1 ELSE 0 END) / sum(CASE WHEN channel_top_{k} OR hurdle_top_{k} THEN 1 ELSE 0 END) END', 'v')} "
    f"FROM {MG}" for k in CAPACITIES), MG, ALLOC)


@query("p08_operational_metrics", _P8_SQL)
def p08_operational_metrics(spark, sf_dir):
    """The operational layer's metric record (overlap, episode counts, repeats avoided, strata)."""
    from caseload.plans.entrypoints import run_operational_layer
    return run_operational_layer(spark, sf_dir)[0]
