import random

import brute
import numpy as np
from caseload.llm import quality as Q
from pyspark.sql import functions as F

key = lambda x: tuple((v is None, v or 0) for v in x)


def test_counts(messy, none, messy_list):
    out = Q.quality(messy)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()), key=key)
    assert got == sorted(((i, *brute.statistics(t)) for i, t in messy_list), key=key)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and (r.distance is None) == r.base_failed or not r.base_failed
    assert Q.quality(none).count() == 0


def test_repeats(spark):
    rng = random.Random(10)
    docs = [(i, rng.choice([" ", "\n", "  ", "\n\n"]).join(rng.choice("abcd#") for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    out = Q.statistics(spark.createDataFrame([(*d, None, "s") for d in docs], "doc_id long, text string, lang string, source string"))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()}
    assert got == {i: brute.statistics(t) for i, t in docs}


def plain_mcd(x):
    """Concentration steps in numpy, as the docstring says."""
    q = lambda v, p: np.sort(v)[max(0, int(np.ceil(p * len(v))) - 1)]
    floor = np.diag(np.array(Q.FLOORS) ** 2)
    middle = np.array([q(c, 0.5) for c in x.T])
    cov = np.diag([(1.4826 * q(abs(c - m), 0.5)) ** 2 for c, m in zip(x.T, middle)]) + floor
    dist = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    det = np.linalg.slogdet(cov)[1]
    for step in range(Q.STEPS):
        d = dist(middle, cov)
        core = x[d <= q(d, Q.CORE)]
        middle, cov = core.mean(axis=0), np.cov(core.T, bias=True) + floor
        was, det = det, np.linalg.slogdet(cov)[1]
        if step and abs(det - was) < Q.SETTLED:
            break
    d = dist(middle, cov)
    return d / max(1.0, q(d, 0.5) / Q.CHI2_MEDIAN)


def test_estimates_agree_with_numpy_and_resist_outliers(spark):
    rng = np.random.default_rng(11)
    rows = []
    for g in ("big", "other"):
        n = 900 if g == "big" else 300
        x = rng.normal(size=(n, 5)) @ rng.normal(size=(5, 5)) + rng.normal(size=5) * 4
        x[: n // 5] += 60  # a fifth far away
        rows += [(g, i, *map(float, v)) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, ["grp", "i", *Q.FEATURES])
    out = frame.join(Q.mcd(frame.drop("i")), "grp").withColumn("distance", Q._distance() / F.col("scale")).toPandas()
    for g, part in out.groupby("grp"):
        part = part.sort_values("i")
        want = plain_mcd(part[list(Q.FEATURES)].to_numpy())
        np.testing.assert_allclose(part["distance"], want, rtol=1e-6)
        n = len(part)
        assert part["distance"][: n // 5].min() > Q.CUTOFF > np.quantile(part["distance"][n // 5:], 0.99)


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randrange(2, 9)))
    clean = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, clean(rng.randrange(60, 900)), "en", "a") for i in range(400)]
    docs += [(1000 + i, clean(200) + "\n" + "One line stands here twice in all\n" * 2, "en", "a") for i in range(3)]
    docs += [(2000 + i, " ".join(word() + rng.choice(["###", "$$$", "%%%"]) for _ in range(150)), "en", "a") for i in range(30)]
    out = Q.quality(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).toPandas()
    assert out[out.doc_id < 2000].kept.all() and not out[out.doc_id >= 2000].kept.any()


def test_every_statistic_can_reject(spark):
    """Duplicate short lines go, 40 % repeated words go, a single repeated line stays; no statistic's range lies under the cutoff."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randrange(2, 9)))
    clean = lambda n: " ".join(word() for _ in range(n))
    short = [clean(2) for _ in range(4)]
    docs = [(i, clean(rng.randrange(60, 900)), "en", "a") for i in range(400)]
    docs += [(1000, clean(200) + "\nOne line stands here twice in all" * 2, "en", "a"),
             (2000, clean(200) + "\n" + "\n".join(rng.choice(short) for _ in range(40)), "en", "a")]
    part = clean(18)
    docs += [(2001, f"{part} {part} {clean(54)}", "en", "a")]
    out = Q.quality(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).toPandas()
    assert not out.base_failed.any()
    assert out[out.doc_id < 2000].kept.all() and not out[out.doc_id >= 2000].kept.any()
    for most, floor in zip((100, 100, 50), Q.FLOORS[2:]):  # percent
        assert np.log1p(most) ** 2 / floor ** 2 > Q.CUTOFF
