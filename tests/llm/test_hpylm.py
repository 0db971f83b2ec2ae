import math
import zlib
from collections import Counter

import numpy as np
import pytest
from caseload.llm import hpylm as H


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def plain_base(docs):
    """(held out, tokens, known, N, base score) by doc position."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    c = Counter(w for (_, t), h in zip(docs, held) if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(h, len(w := tokens(t)), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
            for (_, t), h in zip(docs, held)]


def test_base_and_rows(messy, none, messy_list):
    out = H.score(messy).collect()
    key = lambda x: (x[0], x[1], x[2], x[3], round(x[4], 3))
    assert sorted(key((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in out) == sorted(map(key, plain_base(messy_list)))
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert H.score(none).count() == 0


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64))
    word = np.sort(np.r_[np.arange(len(hashes)), rng.integers(0, len(hashes), 30)])
    context, c, f = rng.integers(0, 33, len(word)), rng.integers(0, 1 << 40, len(word)), rng.random(len(word)).astype("f4")
    for got, want in zip(H.unpack(H.pack(hashes, word, context, c, f)), (hashes, word, context, c, f)):
        np.testing.assert_array_equal(got, want)


def test_seating_follows_the_restaurant():
    """Mean tables of customers seated one by one, against the plain process; few and many customers."""
    rng = np.random.default_rng(2)
    for customers, weight, discount in ((10, 2.0, 0.6), (40, 0.5, 0.3), (400, 5.0, 0.5)):
        plain = []
        for _ in range(1500):
            t = 1
            for i in range(1, customers):
                t += rng.random() < weight / (weight + i - discount * t)
            plain.append(t)
        got = H.seat(np.full(6000, customers), np.full(6000, weight), discount, rng)
        assert got.max() <= customers and abs(got.mean() - np.mean(plain)) < 5 * np.std(plain) / math.sqrt(1500) + 0.03 * np.mean(plain)


def test_probabilities_sum_to_one(spark):
    """Over all known words and the unknown word, in every context."""
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{min(99, int(x))}" for x in rng.pareto(0.7, 50))) for i in range(120)]
    frame = spark.createDataFrame(docs, "id long, text string")
    rows = frame.selectExpr("id", "text", "true AS learn")
    model, seated = H.fit(H.requests(H.in_parts(rows, 1), 4))
    total = model.back_off * model.parent_new * model.unknown
    for r in seated.collect():
        h, word, u, c, t, guests, above = H.unpack(bytes(r.data))
        first = np.searchsorted(word, np.arange(len(h)))
        parent = model.parent(guests[first].astype(float), above[first].astype(float))
        total = total + model.back_off * parent.sum()
        total += np.bincount(u, (c - model.discount * t) / (H.STRENGTH + model.customers[u]), H.CONTEXTS)
    np.testing.assert_allclose(total, 1.0, atol=1e-3)


def test_held_out_perplexity_beats_the_base(spark):
    """Words depend on the word before: two vocabularies that seldom change."""
    rng = np.random.default_rng(4)
    docs = []
    for i in range(400):
        side, out = 0, []
        for _ in range(60):
            side ^= rng.random() < 0.05
            out.append(f"{'ab'[side]}{int(rng.pareto(1.0) * 3) % 500}{('xo', 'ru')[side]}")
        docs.append((i, " ".join(out)))
    out = H.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).toPandas()
    held = out[out.held_out]
    assert len(held) > 50 and held.score.sum() > 0.93 * held.base_score.sum()  # both negative
    assert (held.score > held.base_score).mean() > 0.95


def test_a_changed_part_is_noticed():
    import pandas as pd

    digest = H.Digest(["one two"], 2)
    blocks = list(digest.blocks(np.zeros(len(digest.word), np.int64)))
    model = H.Model(np.r_[2.0, 3, 1, 1, 1, 1, np.ones(2 * H.CONTEXTS)])
    asked = pd.DataFrame({"part": 0, "bucket": [b for b, _ in blocks], "data": [x for _, x in blocks]})
    answers = pd.concat([H._answers(model)((b,), asked[asked.bucket == b], asked[:0]) for b, _ in blocks])
    score = H._score(model, 2)
    assert len(score((0,), pd.DataFrame({"id": [1], "text": ["one two"]}), answers)) == 1
    with pytest.raises(ValueError):
        score((0,), pd.DataFrame({"id": [1], "text": ["one three"]}), answers)


def test_the_word_before_is_a_context(spark):
    """All words end alike, so they are of one class; the word before alone tells the next one."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(300):
        at, out = int(rng.integers(0, 40)), []
        for _ in range(50):
            out.append(f"w{at}zz")
            at = (at * 7 + 3) % 40
        docs.append((i, " ".join(out)))
    out = H.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).toPandas()
    held = out[out.held_out]
    assert len(held) > 30 and held.score.sum() > 0.2 * held.base_score.sum()  # both negative


def test_word_contexts_sum_to_one(spark):
    """Over all known words and the unknown word, after every word that was seen and after others."""
    rng = np.random.default_rng(6)
    docs = [(i, " ".join(f"w{min(99, int(x))}" for x in rng.pareto(0.7, 50))) for i in range(120)]
    rows = spark.createDataFrame(docs, "id long, text string").selectExpr("id", "text", "true AS learn")
    model, seated = H.fit(H.requests(H.in_parts(rows, 1), 4))
    assert (model.place_customers > 0).sum() > 50 and model.place_customers.sum() == 120 * 51
    of = np.arange(H.PLACES + 1) // H.OF_CLASS
    total = (model.place_back_off * (model.back_off * model.parent_new * model.unknown)[of])
    for r in seated.collect():
        h, word, k, g, t, guests, above = H.unpack(bytes(r.data))
        first = np.searchsorted(word, np.arange(len(h)))
        parent = model.parent(guests[first].astype(float), above[first].astype(float))
        inside = np.bincount(k, (g - model.discount * t) / (H.STRENGTH + model.customers[k]), H.CONTEXTS) + model.back_off * parent.sum()
        _, _, u, low, _ = H.unpack(bytes(r.low))
        total += model.place_back_off * inside[of] + np.bincount(u, low, H.PLACES + 1) / (H.STRENGTH + model.place_customers)
    np.testing.assert_allclose(total, 1.0, atol=1e-3)
