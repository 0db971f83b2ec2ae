"""Shared stages that move no panel rows twice, exact medians from two scans."""

import numpy as np
import pytest

from caseload.operators.ranking import cell_medians

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("buckets", [None, 2, 8])
def test_cell_medians_against_numpy(spark, buckets):
    rng = np.random.default_rng(5)
    rows = [(None if c == 0 else c, float(v)) for c in range(6) for v in rng.normal(size=40 + c)]
    rows += [(6, 3.0)] * 5 + [(7, None)] * 3 + [(8, 1e300), (8, -1e300), (8, 2.0), (8, 4.0)] + [(9, 1.0)] * 50 + [(9, float(v)) for v in range(40)]
    df = spark.createDataFrame([(c, v, None if v is None else -2 * v) for c, v in rows], "cell int, x double, y double").repartition(7)
    got = {r.cell: (r.median_x, r.median_y) for r in cell_medians(df, ["cell"], ["x", "y"], buckets).collect()}
    assert set(got) == {c for c, _ in rows}
    for c, (x, y) in got.items():
        values = [v for k, v in rows if k == c and v is not None]
        assert (x, y) == (None, None) if not values else (x == np.median(values) and y == np.median([-2 * v for v in values]))


def test_lens_1_is_a_projection_of_the_written_history(spark):
    """Neither the peer cells nor the flags shuffle the panel's rows."""
    from caseload.plans import inputs as I
    from caseload.plans import workflows as W

    for df in (I.scored(spark, SMALL), W.peer_frame(spark, SMALL)):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_panel_lines_are_shuffled_once_for_both_aggregates(spark):
    from caseload.plans.panel import typed_lines

    plan = typed_lines(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(o_custkey") == 1
