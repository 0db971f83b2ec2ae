import random

import brute
import numpy as np
import pytest
from caseload.llm import graph, jaccard as J


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_rows(messy, none, messy_list):
    out = J.jaccard_components(messy)
    assert out.count() == len(messy_list)
    plain = [(i, t) for i, t in messy_list if i is not None and i != 13]
    want = brute.components(plain)
    for i, x in got(out.where("doc_id is not null and doc_id != 13")).items():
        assert x == want[i], i
    nulls = sorted(((r.n_shingles, r.component_id) for r in out.where("doc_id is null").collect()), key=str)
    assert nulls == sorted([(298, 1), (0, None), (3, None)], key=str)  # the base text, no text, a text of its own
    assert sorted((r.n_shingles, r.component_id) for r in out.where("doc_id = 13").collect()) == [(3, 13), (3, 13), (4, 13)]
    assert J.jaccard_components(none).count() == 0


def variants(rng, n_base, size):
    """Families of texts: edited, shortened and lengthened copies, copies of copies, and shared passages."""
    docs = []
    passage = [f"p{k}" for k in range(size)]
    for b in range(n_base):
        base = [f"b{b}w{rng.randrange(10 ** 6)}" for _ in range(size + rng.randrange(size))]
        family = [base]
        for _ in range(25):
            x = list(rng.choice(family[:6]))
            kind = rng.randrange(4)
            for _ in range(rng.randrange(0, max(2, len(x) // 14))):
                k = rng.randrange(len(x))
                if kind == 0:
                    x[k] = f"e{rng.randrange(10 ** 6)}"
                elif kind == 1 and len(x) > 5:
                    del x[k]
                elif kind == 2:
                    x.insert(k, f"i{rng.randrange(40)}")
                else:
                    x[k] = f"s{rng.randrange(5)}"
            family.append(x)
        family += [passage + [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(1, size))] for _ in range(10)]
        docs += family
    rng.shuffle(docs)
    return [(i, " ".join(x)) for i, x in enumerate(docs)]


@pytest.mark.parametrize("seed, size, words, num", [(1, 30, 3, 90), (2, 120, 3, 90), (3, 60, 5, 80), (4, 14, 1, 80), (5, 300, 2, 85), (6, 40, 1, 70)])
def test_exact_on_families(spark, seed, size, words, num):
    docs = variants(random.Random(seed), 6, size)
    out = J.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), words, num, 100)
    want = brute.components(docs, words, num)
    assert got(out) == want
    assert 6 < len({c for _, c in want.values()}) < len(docs)


def test_regions_meet_all_linked_sets():
    """Any two sets at the limit share a region, at every size."""
    rng = np.random.default_rng(7)
    for num, classes in ((90, J.Classes(90, 100)), (80, J.Classes(80, 100))):
        for n in [*range(1, 60), 90, 150, 400, 1200]:
            for _ in range(6):
                x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                common = rng.integers(0, n + 1)
                extra = 0
                while 100 * (n - common) >= num * (n + extra + 1):  # sets of n - common shared and extra new shingles
                    extra += 1
                if 100 * (n - common) < num * (n + extra):
                    continue
                y = np.r_[x[common:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)]
                if common == 0 and extra == 0:
                    continue
                assert np.intersect1d(classes.regions(np.unique(x)), classes.regions(np.unique(y))).size, (num, n, common, extra)


def test_keep_one(spark, messy, none):
    kept = J.keep_one(messy)
    assert kept.columns == messy.columns and J.keep_one(none).count() == 0
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    comps = got(J.jaccard_components(messy, 5, 80, 100).where("doc_id is not null and doc_id != 13"))
    assert sorted(i for i in ids if i is not None and i != 13) == sorted(i for i, (_, c) in comps.items() if i == c)
    assert ids.count(13) == 3 and ids.count(None) == 2  # the null id's copy of the base text goes


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        up[hi] = lo
    out = {r.v: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {x: find(x) for x in up if find(x) != x}


def test_cell_pairs_of_sets_that_share_too_little(spark):
    """Unlinked sets of a cell that share many differences give no pairs; the linked two of them are found."""
    cells, changes = [], []
    for i in range(60):
        cells.append((0, i, 24, 30, i, False))
        changes.append((0, i, [1000 * (i + 1) + k for k in range(14)] + list(range(1, 17))))
    cells.append((0, 60, 24, 30, 60, False))
    changes.append((0, 60, [1000 + k for k in range(13)] + [99_000] + list(range(1, 17))))  # links to the set 0
    cells.append((0, 61, 24, 4, 61, False))  # near the pivot: it makes the prefixes of all others long
    changes.append((0, 61, [98_000 + k for k in range(4)]))
    near, rest = J._cell_pairs(spark.createDataFrame(cells, "p long, sid long, n long, m long, label long, inner boolean"),
                               spark.createDataFrame(changes, "p long, sid long, change array<long>"), 80, 100)
    assert near.count() == 0
    assert [tuple(r) for r in rest.collect()] == [(0, 60)]
