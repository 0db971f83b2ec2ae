"""F1-F6 of round 4: the panel is made from its months with orders, cells are joined where rows are, audits shuffle bits, ranks shuffle once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from caseload.operators import clean as CL
from caseload.operators.ranking import auc_ap

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def order_tables(spark, path, customers):
    day = dt.date
    rng = random.Random(3)
    orders, lines = [], []
    for c in range(9):
        months = sorted(rng.sample(range(40), (1, 2, 3, 5, 9, 14, 20, 30, 40)[c]))
        for m in months:
            for _ in range(rng.choice((1, 1, 2))):
                k = len(orders)
                orders.append((k, c, day(1999 + m // 12, m % 12 + 1, rng.randint(1, 28))))
                price = 10.0 if c == 8 else None if rng.random() < 0.1 else rng.uniform(1, 90)  # one customer with the same revenue in each order
                lines += [(k, rng.randrange(5), 3.0, price, 0.1, rng.choice("RN"), "F") for _ in range(1 if c == 8 else rng.randrange(3))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(p, ("PROMO", "STANDARD", None)[p % 3]) for p in range(4)], "p_partkey long, p_type string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    return {(c, d.replace(day=1)) for _, c, d in orders}


@pytest.mark.parametrize("twice", [False, True])
def test_history_of_quiet_months_needs_no_window(spark, tmp_path, twice):
    """Only months with orders are written; the panel's rows made from them are those of the windows over all rows."""
    from caseload.plans import inputs as I
    from caseload.plans import panel as P

    path = str(tmp_path)
    ordered = order_tables(spark, path, [(c, c % 3, "AB"[c % 2]) for c in range(1, 9)] * (2 if twice else 1) + [(None, 1, "A")])
    months = I.active_months(spark, path)
    assert months.count() == len(ordered) < I.facts(spark, path).count()
    peers = P.customer_peers(spark, path)
    assert P.peers_are_unique(peers) == (not twice) == ("channel_peer" in months.columns)
    if twice:
        return
    old = {(r.customer_public_id, r.transaction_month): r for r in P.history_panel(I.facts(spark, path), peers).select(*P.HISTORY_COLUMNS).collect()}
    new = P.history_from_states(months).collect()
    assert len(new) == len(old)
    for r in new:
        for name, want in old[r.customer_public_id, r.transaction_month].asDict().items():
            assert r[name] == (pytest.approx(want, rel=1e-9, abs=1e-9) if isinstance(want, float) else want), (name, r)
    assert "Exchange" not in plan(P.history_from_states(months))


def test_panel_rows_are_not_shuffled_for_the_cadence(spark, tmp_path):
    """the window's rows come from the exchange of the months with orders."""
    from caseload.operators.cadence import build_cadence_panel
    from caseload.plans import inputs as I
    from caseload.plans import panel as P

    months = I.active_months(spark, SMALL).repartition("customer_public_id")
    assert plan(build_cadence_panel(P.engineered_panel(P.with_quiet_months(months)))).count("Exchange hashpartitioning") == 1


def test_running_totals_equal_frames(spark):
    """whole order counts take differences of totals, others the frames; both with NULL counts."""
    from caseload.operators.cadence import build_cadence_panel
    from caseload.plans import inputs as I

    rows = I.engineered(spark, SMALL).where("length(customer_public_id) < 3").withColumn("order_count", F.when(F.month("transaction_month") != 3, F.col("order_count")))
    whole, parts = build_cadence_panel(rows), build_cadence_panel(rows.withColumn("order_count", F.col("order_count").cast("double")))
    assert "_orders_upto" in plan(whole) and "_orders_upto" not in plan(parts)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_small_cells_are_broadcast_below_any_threshold(spark):
    from caseload.operators.joins import join_cells

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = spark.createDataFrame([(None, 1.0), (2, 2.0)], "k int, v double")
        joined = join_cells(spark.createDataFrame([(None,), (2,), (3,)], "k int"), cells, ["k"])
        assert "BroadcastHashJoin" in plan(joined) and {tuple(r) for r in joined.collect()} == {(None, 1.0), (2, 2.0), (3, None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_forward_rows_are_written_once(spark, monkeypatch):
    """what is written for the queues are the ranked keys, not the frame with its flags."""
    from caseload.config import S2Config
    from caseload.plans import workflows as W

    written, keep = [], W.scratch_table
    monkeypatch.setattr(W, "scratch_table", lambda df: written.append(len(df.columns)) or keep(df))
    frame = W.peer_frame(spark, SMALL, S2Config(zero_order_bonus=0.125))
    assert sorted(written)[:-1] == [3, 3, 3] and set(W.flag_columns()) <= set(frame.columns)


@pytest.mark.parametrize("bits", [600, 0])
def test_panel_quality_counts_odd_keys(spark, monkeypatch, bits):
    """NULL and repeated keys; no row is copied for the distinct counts."""
    monkeypatch.setattr(CL, "KEY_MONTHS", bits)
    month = lambda m: None if m is None else dt.date(1990 + m // 12, m % 12 + 1, 1)
    rng = random.Random(4)
    keys = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(150)])) for _ in range(400)]
    rows = [(c, month(m), rng.choice([None, True, False]), rng.choice([None, True]), rng.choice([None, 1.0])) for c, m in keys]
    df = spark.createDataFrame(rows, "customer_public_id string, transaction_month date, zero_order_month_flag boolean, sparse_history_flag boolean, hybrid_s2_score double")
    out = CL.panel_quality(df, ["hybrid_s2_score"])
    got, zero = out.first(), [r[2] for r in rows if r[2] is not None]
    assert (got.customer_month_rows, got.distinct_customers, got.months) == (400, 3, len({m for _, m in keys} - {None}))
    assert got.duplicate_customer_month_rows == 400 - len(set(keys)) and got.zero_order_month_rate == sum(zero) / len(zero)
    assert got.hybrid_null_scores == sum(r[4] is None for r in rows) and got.month_start == min(r[1] for r in rows if r[1])
    assert "Expand" not in plan(out)
    none = CL.panel_quality(df.where("false"), ["hybrid_s2_score"]).first()
    assert (none.customer_month_rows, none.duplicate_customer_month_rows, none.zero_order_month_rate) == (0, 0, None)


def test_cleaning_audit_shuffles_no_text(spark):
    """what the audit shuffles are keys, the sequence and words of bits; the panel is read once for a row and its duplicate."""
    from caseload.plans import inputs as I
    from caseload.plans.dirty import NUMERIC, dirty_panel

    raw = dirty_panel(I.scored(spark, SMALL))
    cleaned = CL.clean_panel(raw, NUMERIC)
    audit = CL.cleaning_audit(raw, cleaned, NUMERIC)
    assert "Union" not in plan(audit)
    got = {r.step: r.rows for r in audit.collect()}
    kept = cleaned.select(*[F.sum(F.col(f"_coerced_{c}").cast("int")).alias(c) for c in NUMERIC]).first()
    assert got["coerced_values"] == sum(kept) > 0 and got["rows_passed"] == cleaned.count() < got["rows_loaded"]
    shuffled = plan(audit).split("Exchange hashpartitioning(customer_public_id")[1].split("Project [")[1].splitlines()[0]
    assert "AS _audit0" in shuffled and "AS net_revenue_yoy_ratio" not in shuffled


def test_a_ranking_shuffles_its_values_once_for_buckets_and_once_for_sums(spark):
    """one scan finds bounds, one totals, one shuffles."""
    rng = random.Random(6)
    rows = [("ab"[i % 2], int(rng.random() < 0.4), float(rng.choice([rng.random(), 0.5]))) for i in range(500)] + [("c", 1, None), (None, 1, 2.0), (None, 0, 1.0)]
    df = spark.createDataFrame(rows, "split string, y int, score double")
    out = auc_ap(df, "y", "score", ["split"])
    assert sum("score" in x for x in plan(out).splitlines() if "Exchange hashpartitioning" in x) == 1
    for r in out.collect():
        mine = [(s, y) for k, y, s in rows if k == r.split and s is not None]
        pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
        pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert r.roc_auc == pytest.approx(pairs / (len(pos) * len(neg)))
