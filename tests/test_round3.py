"""One-pass pilot draw, sized prefix scan and the lens-1 record against plain Python."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MONTH = dt.date(2001, 7, 1)
FLAGS = ("channel_top_250", "company_division_top_250", "hybrid_top_250", "hurdle_top_250")


def _merged(spark, n, seed, share):
    rng = random.Random(seed)
    rows = [(f"c{i}", MONTH, *[rng.random() < share for _ in FLAGS]) for i in range(n)]
    rows += [(f"c{i}", dt.date(2001, 6, 1), True, False, True, False) for i in range(7)]  # an older month
    return rows, spark.createDataFrame(rows, "customer_public_id string, transaction_month date, " + ", ".join(f"{f} boolean" for f in FLAGS))


def _serial(rows, targets):
    """The draw as written down: stratum by stratum, seeded md5 order, no customer twice, then the fill."""
    from caseload.config import RANDOM_STATE

    latest = [r for r in rows if r[1] == MONTH]
    masks = {"agreement_core": lambda a, b, c, h: a and h, "channel_only": lambda a, b, c, h: a and not h, "hurdle_only": lambda a, b, c, h: h and not a,
             "peer_definition_disagreement": lambda a, b, c, h: a != b or a != c, "background": lambda a, b, c, h: not (a or b or c or h)}
    order = lambda seed: lambda r: (hashlib.md5(f"{seed}|{r[0]}|{r[1]}".encode()).hexdigest(), r[0])
    taken, sizes = {}, {}
    for i, (name, target) in enumerate(targets):
        pool = [r for r in latest if masks[name](*r[2:])]
        sizes[name] = len(pool)
        for r in sorted((r for r in pool if r[0] not in taken), key=order(RANDOM_STATE + i))[:target]:
            taken[r[0]] = name
    total = sum(t for _, t in targets)
    for r in sorted((r for r in latest if r[0] not in taken), key=order(RANDOM_STATE + 99))[:total - len(taken)]:
        taken[r[0]] = "capacity_fill"
    filled = sum(min(sizes[n], t) for n, t in targets)
    shares = {n: min(1.0, t / max(1, sizes[n])) for n, t in targets}
    shares["capacity_fill"] = min(1.0, max(0, total - filled) / max(1, len(latest) - filled))
    return {c: (s, round(shares[s], 12)) for c, s in taken.items()}


@pytest.mark.parametrize("n, share", [(0, 0.5), (3, 0.5), (40, 0.0), (40, 1.0), (60, 0.3), (300, 0.5), (300, 0.1)])
def test_pilot_draw_equals_the_serial_choice(spark, n, share):
    from caseload.operators.pilot import pilot_allocation

    targets = (("agreement_core", 4), ("channel_only", 6), ("hurdle_only", 0), ("peer_definition_disagreement", 9), ("background", 5))
    rows, merged = _merged(spark, n, n, share)
    if not n:  # nothing at all
        rows, merged = [], merged.where("false")
    out = pilot_allocation(merged, 250, targets).collect()
    assert {r.customer_public_id: (r.sampling_stratum, round(r.inclusion_probability, 12)) for r in out} == _serial(rows, targets)
    assert len(out) == len({r.case_id for r in out}) and all(r.transaction_month == MONTH for r in out)


def test_pilot_draw_is_planned_as_partial_top_k(spark):
    from caseload.operators.pilot import pilot_allocation

    _, merged = _merged(spark, 50, 1, 0.4)
    plan = pilot_allocation(merged, 250)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Scan ExistingRDD") == 2


@pytest.mark.parametrize("buckets", [None, 2, 3, 8, 50, 257])
def test_prefix_scan_is_exact_for_any_number_of_buckets(spark, buckets):
    from caseload.operators.ranking import value_prefix

    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0.0, -1.5, rng.random(), float(rng.randrange(40)), None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    for by in ([], ["g"]):
        got = value_prefix(df, "v", {"n": F.lit(1)}, by=by, n_buckets=buckets).collect()
        truth = {}
        for g, v in rows:
            if v is not None:
                truth.setdefault(g if by else 0, []).append(v)
        assert len(got) == sum(len(set(vs)) for vs in truth.values())
        for r in got:
            vs = truth[r.g if by else 0]
            assert (r.n, r.n_below) == (vs.count(r.v), sum(x < r.v for x in vs))
    assert value_prefix(df.where("false"), "v", {"n": F.lit(1)}, n_buckets=buckets).count() == 0


def test_lens_1_record_of_a_prepared_frame(spark):
    import pandas as pd

    from caseload.config import DEFAULT_CALENDAR, SplitCalendar
    from caseload.plans import inputs as I
    from caseload.plans.entrypoints import run_peer_strategy_evaluation

    scored = I.scored(spark, SMALL)
    cal = SplitCalendar(forward_start=DEFAULT_CALENDAR.calib_start)  # a caller's window: nine months
    # a baseline that is NULL in places and tied in others
    third = F.crc32(F.concat_ws("|", "customer_public_id", "transaction_month").cast("binary")) % 3
    frame = scored.withColumn("baseline_anomaly_score", F.when(third == 0, F.col("baseline_anomaly_score")).when(third == 1, F.round("baseline_anomaly_score", 0)))
    record, forward = run_peer_strategy_evaluation(spark, SMALL, {"zero_order_bonus": 0.5}, frame, cal=cal)
    got = {(r.section, r.key, r.metric): r.value for r in record.collect()}
    rows = forward.join(frame.select("customer_public_id", "transaction_month", "baseline_anomaly_score"), ["customer_public_id", "transaction_month"]).toPandas()
    assert got["forward_months", "window", "start"] == 200011 and got["output", "peer_forward", "rows"] == len(rows)
    assert got["s2_score_config", "caller_supplied", "zero_order_bonus"] == 0.5
    assert got["peer_input", "caller_prepared_frame", "rows"] == scored.count()
    assert got["s2_score_config", "caller_supplied", "aggregation=maximum_absolute_signal"] == 1
    base = rows.baseline_anomaly_score.astype(float).round(9)
    near = lambda x: pytest.approx(x, abs=1e-9)
    spearman = lambda a, b: a[b.notna()].rank().corr(b[a.notna()].rank())
    assert 0 < base.isna().sum() < len(rows)
    assert got["baseline_reproduction", "channel_vs_current_s2", "spearman"] == near(spearman(rows.channel_s2_score, base))
    assert got["baseline_reproduction", "channel_vs_current_s2", "pearson"] == near(rows.channel_s2_score.corr(rows.baseline_anomaly_score.astype(float)))
    for s in ("company_division", "hybrid"):
        assert got["strategy_metrics", s, "spearman_vs_channel"] == near(spearman(rows[f"{s}_s2_score"], rows.channel_s2_score))
        assert got["score_distribution", s, "p95"] == near(rows[f"{s}_s2_score"].quantile(0.95))
        a, b = rows.channel_top_100, rows[f"{s}_top_100"]
        assert got["capacity_overlap", f"100|channel_vs_{s}", "pooled_jaccard"] == near((a & b).sum() / (a | b).sum())
        assert got["capacity_overlap", f"100|channel_vs_{s}", "changed_customer_months"] == (a != b).sum()
        monthly = pd.DataFrame({"m": rows.transaction_month, "both": a & b, "either": a | b}).groupby("m").sum()
        assert got["capacity_overlap", f"100|channel_vs_{s}", "mean_monthly_jaccard"] == near((monthly.both / monthly.either).mean())
    tail = rows.company_division_s2_score >= rows.company_division_s2_score.quantile(0.99)
    assert got["company_division_tail_diagnostic", "forward", "top_one_percent_rows"] == tail.sum()

    with pytest.raises(ValueError, match="grain"):
        run_peer_strategy_evaluation(spark, SMALL, prepared_frame=scored.unionByName(scored.limit(1)))
    none = {(r.section, r.key, r.metric): r.value for r in run_peer_strategy_evaluation(spark, SMALL, prepared_frame=scored.where("false"))[0].collect()}
    assert none["peer_input", "caller_prepared_frame", "rows"] in (0, None) and none["strategy_metrics", "hybrid", "pearson_vs_channel"] is None
