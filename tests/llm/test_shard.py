import random
import zlib

from caseload.llm import shard as S


def least_capacity(sizes, shards):
    """Dynamic programming: least possible largest run."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        new = [0] + [float("inf")] * len(sizes)
        for end in range(1, len(sizes) + 1):
            run = 0
            for start in range(end - 1, -1, -1):
                run += sizes[start]
                new[end] = min(new[end], max(best[start], run))
        best = new
    return best[-1]


def test_capacity_is_minimax():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.choice((1, 3, 10, rng.randrange(1, 200))) for _ in range(rng.randrange(1, 25))]
        k = rng.randrange(1, 7)
        assert S.smallest_capacity(sizes, [True] * len(sizes), k) == least_capacity(sizes, k)


def test_plan_is_exact_over_groups(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BITS", 3)  # blocks must be split to place the cuts
    rng = random.Random(2)
    rows = sorted((rng.randrange(1 << 62) * 2 + 1, rng.randrange(1, 500)) for _ in range(300))
    groups = spark.createDataFrame(rows, "key long, bytes long").cache()
    capacity, cuts, _ = S.plan_cuts(groups, [], sum(s for _, s in rows), 7)
    assert capacity == least_capacity([s for _, s in rows], 7)
    runs = [0] * 7
    for k, s in rows:
        runs[sum(c <= k for c in cuts)] += s
    assert max(runs) == capacity


def test_rows(messy, none, messy_list):
    out = [r.asDict() for r in S.shard(messy, 4).collect()]
    assert len(out) == len(messy_list)
    key = lambda i: (i is None, i)
    want = sorted((key(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in messy_list)
    assert sorted((key(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    by_text = {}
    for r in out:
        assert by_text.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    for s in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert S.shard(none, 4).count() == 0


def test_heavy_groups_do_not_spoil_the_balance(spark):
    """Three groups of near a shard's size each, and one of a third of all rows."""
    rows = [(i, "a" * 900) for i in range(700)] + [(i, "b" * 800) for i in range(700, 1300)] + [(i, "") for i in range(1300, 3000)]
    rows += [(i, f"text {i} " + "z" * (i % 400)) for i in range(3000, 12000)]
    out = S.shard(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    sizes = [r[1] for r in out.groupBy("shard").sum("size").collect()]
    rest = [x for x in sizes if x != 700 * 901]  # the largest group is more than a fifth: it stands alone
    assert len(rest) == 4 and max(rest) < 1.02 * sum(rest) / 4
    assert out.select("shard", "slot").distinct().count() == len(rows)
    assert [r[0] for r in out.groupBy("shard").agg({"slot": "max"}).collect()] and all(
        r["max(slot)"] + 1 == r["count(1)"] for r in out.groupBy("shard").agg({"slot": "max", "*": "count"}).collect())
