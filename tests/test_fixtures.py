"""Unit fixtures restated from the workflow's own tests (see FIXTURES.md, F1-F15)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseload.config import CADENCE_FEATURES, FORBIDDEN_PREDICTIVE_COLUMNS, S2Config
from caseload.sources.contracts import PEER_INPUT_COLUMNS, require_columns


def d(y, m):
    return dt.date(y, m, 1)


def add_months(day, n):
    y, m = divmod(day.month - 1 + n, 12)
    return dt.date(day.year + y, m + 1, 1)


def test_f1_cadence_targets_and_leakage(spark):
    from caseload.operators.cadence import build_cadence_panel
    from caseload.sources.contracts import ENGINEERED_SCHEMA

    rows = []
    for c in range(2):
        for m in range(15):
            month = add_months(d(2024, 1), m)
            o = int((m + c) % 3 == 0)
            rows.append((f"synthetic-{c}", month, d(2024, 1), o, o, 2 * o, .1 * o, .2 * o, 0.0, .5 * o))
    panel = build_cadence_panel(spark.createDataFrame(rows, ENGINEERED_SCHEMA)).toPandas()
    assert panel.groupby("customer_public_id").size().tolist() == [14, 14]
    for r in panel.itertuples():
        assert r.target_month == add_months(r.transaction_month, 1)
    assert not set(CADENCE_FEATURES) & FORBIDDEN_PREDICTIVE_COLUMNS
    # next target equals the following row's activity
    p0 = panel[panel.customer_public_id == "synthetic-0"].sort_values("transaction_month")
    assert p0.next_has_order.tolist()[:-1] == p0.current_has_order.tolist()[1:]


def test_f4_score_config_validation():
    assert S2Config.resolve({"zero_order_bonus": .5, "sparse_history_multiplier": .8}).zero_order_bonus == .5
    with pytest.raises(ValueError, match="aggregation"):
        S2Config.resolve({"aggregation": "mean"})
    with pytest.raises(ValueError):
        S2Config.resolve({"unknown": 1})


def test_f5_missing_columns(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in PEER_INPUT_COLUMNS[:-1]))
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(df, PEER_INPUT_COLUMNS)


def test_f6_expanding_folds(spark):
    from caseload.operators.baselines import fold_boundaries

    rows = [(add_months(d(2025, 1), m), "train") for m in range(6) for _ in range(2)]
    df = spark.createDataFrame(rows, "target_month date, data_split string")
    b = fold_boundaries(df, F.col("data_split") == "train", n_folds=2).orderBy("fold").toPandas()
    assert len(b) == 2
    assert b.train_rows.tolist() == [4, 8]
    assert b.validation_rows.tolist() == [4, 4]
    assert (b.train_end < b.validation_start).all()
    assert b.train_start.nunique() == 1


def test_fold_blocks_nine_into_four(spark):
    from caseload.operators.baselines import month_blocks

    rows = [(add_months(d(2020, 1), m),) for m in range(9)]
    df = spark.createDataFrame(rows, "target_month date")
    blocks = month_blocks(df, F.lit(True), n_folds=3).groupBy("block").count().orderBy("block").toPandas()
    assert blocks["count"].tolist() == [3, 2, 2, 2]


def test_f7_reliability_bins(spark):
    from caseload.operators.metrics import reliability_bins

    df = spark.createDataFrame([("m", 0, .01), ("m", 0, .24), ("m", 1, .51), ("m", 1, 1.0)], "model string, y int, p double")
    r = reliability_bins(df, 4).orderBy("bin").toPandas()
    assert r.rows.sum() == 4
    assert r.bin.tolist() == [1, 3, 4] and r.rows.tolist() == [2, 1, 1]
    assert r.observed_activity_rate.between(0, 1).all()


def test_f8_bootstrap(spark):
    from caseload.operators.bootstrap import clustered_bootstrap

    df = spark.createDataFrame([("a", 0, .1, .6), ("a", 1, .9, .4), ("b", 0, .2, .7), ("b", 1, .8, .3)],
                               "customer string, y int, selected double, baseline double")
    run = lambda: clustered_bootstrap(df, cluster="customer", y="y", selected="selected", baseline="baseline",
                                      baseline_name="b", resamples=25).orderBy("metric").toPandas()
    a, b = run(), run()
    assert a.equals(b)
    assert a.forward_customers.tolist() == [2, 2]
    ll = a[a.metric == "log_loss"].iloc[0]
    auc = a[a.metric == "roc_auc"].iloc[0]
    assert ll.point_difference == pytest.approx(0.164252 - 1.060132, abs=1e-5)
    assert auc.point_difference == pytest.approx(1.0)
    assert "customer" not in a.columns


def test_f9_local_path_scan(spark):
    from caseload.config import LOCAL_PATH_PATTERNS
    from caseload.operators.audit import pattern_findings

    df = spark.createDataFrame([("x", 1, "see /Users/alice/project/file.py"), ("x", 2, "see docs/readme.md")],
                               "source string, id long, text string")
    ids = [r.id for r in pattern_findings(df, LOCAL_PATH_PATTERNS).collect()]
    assert ids == [1]


def test_f10_inventory_filter(spark):
    from caseload.operators.audit import inventory_decision

    df = spark.createDataFrame([("docs/a.md",), ("docs/b.csv",), ("src/.env",), ("figures/c.parquet",)], "path string")
    got = {r.path: r.allowed for r in inventory_decision(df).collect()}
    assert got == {"docs/a.md": True, "docs/b.csv": False, "src/.env": False, "figures/c.parquet": False}


def test_f11_quality_and_monthly_activity(spark):
    from caseload.operators.clean import monthly_activity, panel_quality

    df = spark.createDataFrame([
        ("a", d(2026, 1), False, False, 1.0, 1.0, 1.0),
        ("b", d(2026, 1), True, True, None, 1.5, 1.5),
        ("a", d(2026, 2), False, False, 2.0, 2.0, 2.0)],
        "customer_public_id string, transaction_month date, zero_order_month_flag boolean, sparse_history_flag boolean, "
        "channel_s2_score double, company_division_s2_score double, hybrid_s2_score double")
    q = panel_quality(df, ["channel_s2_score", "company_division_s2_score", "hybrid_s2_score"]).collect()[0]
    assert (q.customer_month_rows, q.distinct_customers, q.duplicate_customer_month_rows, q.channel_null_scores) == (3, 2, 0, 1)
    m = monthly_activity(df).orderBy("transaction_month").collect()
    assert [r.customer_month_rows for r in m] == [2, 1]
    assert [r.activity_rate for r in m] == [.5, 1.0]


def test_f12_topk(spark):
    from caseload.operators.queues import attach_topk_flags

    rows = [(f"c{i}", d(2026, 1) if i < 5 else d(2026, 2), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_public_id string, transaction_month date, score double")
    out = attach_topk_flags(df, "score", [2], "s").where("s_top_2").collect()
    assert sorted(r.customer_public_id for r in out) == ["c3", "c4", "c8", "c9"]


def test_f13_waterfill(spark):
    from caseload.operators.queues import attach_waterfill_flags

    dirs = ["unexpected_inactivity"] * 2 + ["unexpected_activity"] * 3 + ["unexpected_active_pattern"] * 4
    rows = [(f"c{i}", d(2026, 1), float(i), dirs[i]) for i in range(9)]
    df = spark.createDataFrame(rows, "customer_public_id string, target_month date, score double, direction string")
    out = attach_waterfill_flags(df, "score", "direction", [6], "h").where("h_top_6").collect()
    assert sorted(r.customer_public_id for r in out) == ["c0", "c1", "c3", "c4", "c7", "c8"]
    assert len({r.direction for r in out}) == 3


def test_f14_episodes(spark):
    from caseload.operators.episodes import episode_table

    rows = [("a", d(2026, 1), 5.0, "down", True), ("a", d(2026, 2), 6.0, "down", True),
            ("a", d(2026, 3), 7.0, "up", True), ("b", d(2026, 1), 4.0, "down", True)]
    df = spark.createDataFrame(rows, "customer_public_id string, transaction_month date, score double, "
                                     "signal_direction string, flag boolean")
    ep = {(r.customer_public_id, r.episode_number): r for r in episode_table(df, "test").collect()}
    assert len(ep) == 3
    assert max(r.months_flagged for r in ep.values()) == 2
    assert ep[("a", 1)].episode_id == "b0a855333b84ed3c"
    assert ep[("a", 2)].episode_id == "e298a448791c4ef9"
    assert ep[("b", 1)].episode_id == "bc952a691e1b3283"


def test_f15_blinded_sample(spark):
    import __spark_entry__ as E

    df = E.queries()["p06_blinded_sample"](spark, "/root/testdata/sf0.01")
    assert df.count() == 250
    assert "customer_public_id" not in df.columns and "sampling_stratum" not in df.columns
    assert "case_id" in df.columns


def test_bootstrap_poisson_variant_agrees(spark):
    from caseload.operators import baselines as BL
    from caseload.operators.bootstrap import clustered_bootstrap
    from caseload.plans import inputs as I

    cad = I.cadence(spark, "/root/testdata/sf0.001")
    fwd = BL.apply_baselines(cad.where(F.col("data_split") == "forward"), cad.where(F.col("data_split") == "train"))
    kw = dict(cluster="customer_public_id", y="next_has_order", selected="p_markov", baseline="p_global",
              baseline_name="g", resamples=200)
    a = {r.metric: r for r in clustered_bootstrap(fwd, **kw).collect()}
    b = {r.metric: r for r in clustered_bootstrap(fwd, method="poisson", **kw).collect()}
    b2 = {r.metric: r for r in clustered_bootstrap(fwd, method="poisson", **kw).collect()}
    assert b == b2
    for m in ("log_loss", "roc_auc"):
        assert a[m].point_difference == pytest.approx(b[m].point_difference)
        # intervals overlap and have similar width
        assert b[m].ci_low <= a[m].ci_high and a[m].ci_low <= b[m].ci_high
        wa, wb = a[m].ci_high - a[m].ci_low, b[m].ci_high - b[m].ci_low
        assert 0.5 < wb / wa < 2.0
