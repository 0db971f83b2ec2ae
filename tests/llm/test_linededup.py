import random

import brute
from caseload.llm import linededup as L

key = lambda x: tuple((v is None, 0 if v is None else v) for v in x)


def rows(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in frame.collect()), key=key)


def test_rows(messy, none, messy_list):
    want = sorted(brute.line_dedup(messy_list), key=key)
    assert rows(L.dedup_lines(messy)) == want and sum(w[2] for w in want) > 10
    assert rows(L.dedup_lines(messy, sent_keys=0)) == want  # the shuffle join
    out = L.dedup_lines(messy)
    assert set(out.columns) == set(messy.columns) | {"n_dropped"} and out.schema["n_lines"].dataType.simpleString() == "bigint"
    assert L.dedup_lines(none).count() == 0


def test_random_lines(spark):
    rng = random.Random(9)
    pool = [f"{'Line' if i % 2 else 'lIne'} number {i % 40} padded to a fair length é{i % 3}" for i in range(90)]
    docs = [(rng.choice([None, *range(60)]), "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for _ in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for least in (2, 5):
        assert rows(L.dedup_lines(frame, least_docs=least)) == sorted(brute.line_dedup(docs, 40, least), key=key)


def test_filter_merges_over_many_tasks(spark, monkeypatch):
    """A key that each of 130 tasks sees once survives the merge in rounds; most single keys are not suspected."""
    docs = [(i, f"the one line that all the documents share between them\nline {i} is a line that no other document has {i * i}") for i in range(130)]
    frame = spark.createDataFrame(docs, "id long, text string").repartition(130)
    held = L.suspects(frame, 1 << 20, 40)
    counts = [r["count"] for r in held.groupBy("key").count().collect()]
    assert 130 in counts and len(counts) < 10
