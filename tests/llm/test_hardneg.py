"""Hard negatives against brute force; the threshold algorithm stops early where it may."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from caseload.llm import hardneg as H

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string, key int, chunk int, x string, id string"


def _table(rng, n=300, dims=6):
    rows = []
    for i in range(n):
        label = rng.randrange(3)
        rows.append((i, [float(np.float32(rng.gauss(0.3 * (label == d), 0.4))) for d in range(dims)], label))
    rows += [(n, [0.0] * dims, 0), (n + 1, rows[0][1], 1), (n + 2, rows[0][1], rows[0][2]), (None, rows[0][1], 0), (n + 3, None, 0), (n + 4, rows[1][1], None),
             (n + 5, [None] * dims, 1), (n + 6, [float("nan")] * dims, 1), (n + 7, [float("inf")] + [0.0] * (dims - 1), 1), rows[5], rows[10]]
    return [(*r, 1, "r", 2, 3, "x", "i") for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(H, "CHUNK_ROWS", 90)
    monkeypatch.setattr(H, "FIRST_DEPTH", 2)
    rows = _table(random.Random(seed))
    got = H.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0)
    want = brute.hard_negatives([r[:3] for r in rows], lambda i: i % 10 == 0)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want


def test_no_rows(spark):
    df = spark.createDataFrame(_table(random.Random(1)), SCHEMA)
    assert H.mine_hard_negatives(df.where("false"), F.lit(True)).count() == 0
    assert H.mine_hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_stops_early_and_reads_both_ends():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(0, 20, (4000, 3)))
    x[7], x[8] = (300, -300, 300), (290, -290, 290)
    lists = H.Lists(np.arange(4000), np.zeros(4000, np.int64), x)
    a = np.array([1.0, -1.0, 1.0])
    read = [len(rows) for rows, *_ in lists.accesses(a)]
    assert sum(read) == 4000 and len(read) > 3
    taken = []
    real = H.Lists.accesses
    H.Lists.accesses = lambda self, v: (taken.append(len(r[0])) or r for r in real(self, v))
    try:
        assert lists.positives(7, 0, a, 1) == [(870, 8)]
    finally:
        H.Lists.accesses = real
    assert sum(taken) < 100


def test_large_and_zero_components():
    x = np.array([[2.0 ** 40, 1.0], [2.0 ** 40, 2.0], [0.0, 0.0]])
    lists = H.Lists(np.arange(3), np.zeros(3, np.int64), x)
    assert lists.positives(9, 0, np.array([2.0 ** 20, 3.0]), 3) == [(2 ** 60 + 6, 1), (2 ** 60 + 3, 0), (0, 2)]
    assert lists.positives(9, 0, np.zeros(2), 2) == [(0, 0), (0, 1)]
    with pytest.raises(ValueError):
        lists.positives(9, 0, np.array([2.0 ** 40, 0.0]), 1)
