"""the logistic fit needs medians only, and its passes run all tasks at once."""

import numpy as np
import pytest

from caseload.operators import models as ML
from caseload.operators.ranking import cell_medians

SMALL = "/root/testdata/sf0.001"


def test_feature_medians_against_cell_medians(spark):
    rng = np.random.default_rng(8)
    names = ML.FEATURES[:9]
    columns = [rng.normal(size=301), rng.integers(0, 3, 301), np.full(301, 4.0), rng.lognormal(sigma=9, size=301), [None] * 301,
               [None if i % 2 else float(i) for i in range(301)], [0.0] * 299 + [1e300, -1e300], [float("nan") if i % 3 == 0 else 1.0 * i for i in range(301)], [float("inf")] * 200 + [1.0] * 101]
    rows = [tuple(None if c[i] is None else float(c[i]) for c in columns) for i in range(301)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    for part in (df, df.limit(300).localCheckpoint(), df.limit(1).localCheckpoint()):
        old = cell_medians(part.selectExpr("1 AS one", "*"), ["one"], names).first()
        want = [0.0 if old[f"median_{n}"] is None else old[f"median_{n}"] for n in names]
        assert np.array_equal(ML.feature_medians(part, names), want, equal_nan=True)
    assert not ML.feature_medians(df.where("false"), names).any()


@pytest.mark.parametrize("collected", [256, 8])
def test_a_logistic_pass_is_one_job(spark, monkeypatch, collected):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], f"{ML.FEATURES[0]} double, {ML.FEATURES[1]} double, next_has_order int").repartition(20).localCheckpoint()
    monkeypatch.setattr(ML, "COLLECTED", collected)
    spark.sparkContext.setJobGroup(f"logistic-{collected}", "fit")
    fit = ML.fit_logistic(df, ML.Logistic(), np.zeros(2), features=ML.FEATURES[:2])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"logistic-{collected}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 * (fit.iterations + 2)  # 20 a pass when partitions come one by one
    w, b = fit.coefficients, fit.intercept
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    p = 1 / (1 + np.exp(-(z @ w + b)))
    assert np.abs(z.T @ (p - y) + w / fit.settings.C).max() < 1e-4 and abs((p - y).sum()) < 1e-4


def test_the_logistic_fit_bins_nothing(spark, monkeypatch):
    from caseload.plans import workflows as W

    monkeypatch.setattr(W, "activity_inputs", lambda *a: pytest.fail("blocks were made"))
    assert len(W.logistic_model(spark, SMALL, ML.Logistic(C=0.123)).coefficients) == len(ML.FEATURES)
