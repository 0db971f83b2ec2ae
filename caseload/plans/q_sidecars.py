"""Registered queries: the four committed sidecars (SNK1), read back through their manifest."""

from __future__ import annotations

from caseload.plans import q_hurdle, q_ops, q_s2  # noqa: F401  (their SQL is restated here)
from caseload.plans import workflows as W
from caseload.plans.oracle import with_ctes
from caseload.plans.q_ops import ALLOC, MG, _EPISODES
from caseload.plans.q_s2 import PF
from caseload.plans.registry import REGISTRY, query
from caseload.sources import sidecars as SC


def _read(spark, sf_dir, name):
    root, manifest = W.committed_sidecars(spark, sf_dir)
    return SC.read(spark, root, name, manifest)


@query("snk1_peer_forward_sidecar", REGISTRY["s13_peer_forward"].sql)
def snk1_peer_forward_sidecar(spark, sf_dir):
    """SNK1: lens-1 forward rows, committed by month and read back by digest."""
    return _read(spark, sf_dir, "peer_forward")


@query("snk1_hurdle_sidecar", REGISTRY["h01_h06_forward_predictions"].sql)
def snk1_hurdle_sidecar(spark, sf_dir):
    """SNK1: lens-2 forward predictions, committed and read back by digest."""
    return _read(spark, sf_dir, "hurdle_predictions")


@query("snk1_episode_sidecar", REGISTRY["q10_alert_episodes"].sql)
def snk1_episode_sidecar(spark, sf_dir):
    """SNK1: both lenses' episodes, committed by lens and read back by digest."""
    return _read(spark, sf_dir, "episodes")


@query("snk1_allocation_sidecar", REGISTRY["p02_p05_pilot_allocation"].sql)
def snk1_allocation_sidecar(spark, sf_dir):
    """SNK1: the pilot's key table, committed and read back by digest."""
    return _read(spark, sf_dir, "pilot_allocation")


@query("snk1_committed_set", with_ctes(
    f"SELECT 'peer_forward' AS sidecar, count(*) AS rows, 'customer_public_id,transaction_month' AS keys FROM {PF} WHERE forward "
    "UNION ALL SELECT 'hurdle_predictions', count(*), 'customer_public_id,target_month' FROM hb "
    f"UNION ALL SELECT 'episodes', count(*), 'episode_id' FROM ({_EPISODES}) e "
    f"UNION ALL SELECT 'pilot_allocation', count(*), 'case_id' FROM {ALLOC}", PF, "hb", MG, ALLOC))
def snk1_committed_set(spark, sf_dir):
    """SNK1: what the current manifest names: rows and keys of each sidecar."""
    root, _ = W.committed_sidecars(spark, sf_dir)
    return SC.listing(spark, SC.current(spark, root)).select("sidecar", "rows", "keys")
