import random
import zlib

import numpy as np
from caseload.llm import toxicity as X


def test_gradient_is_that_of_the_loss():
    """One Adam step from zero moves every parameter against the sign of the numerical gradient."""
    rng = np.random.default_rng(1)
    docs = [rng.choice(12, rng.integers(1, 6), replace=False) for _ in range(40)]
    labels = rng.integers(0, 2, 40).astype(float)

    def loss(b, w, v):
        out = 0.0
        for d, y in zip(docs, labels):
            p = X.sigmoid(X.Machine(b, w, v, {}).logit(d))
            out -= y * np.log(p) + (1 - y) * np.log(1 - p)
        return out / len(docs)

    start = X.fit(docs, labels, 12, epochs=0)
    step = X.fit(docs, labels, 12, epochs=1, batch=40, rate=1e-3, decay=0.0)
    for k, eps in ((1, 1e-5), (2, 1e-5)):
        for at in np.ndindex(start[k].shape):
            up, down = [[x.copy() if isinstance(x, np.ndarray) else x for x in start] for _ in range(2)]
            up[k][at] += eps
            down[k][at] -= eps
            slope = (loss(*up) - loss(*down)) / (2 * eps)
            if abs(slope) > 1e-5:
                assert np.sign(step[k][at] - start[k][at]) == -np.sign(slope)


def test_learns_an_interaction():
    """Toxic only if an insult and a group stand together: additive weights cannot say that."""
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for _ in range(4000):
        x = rng.random(20) < 0.5
        docs.append(np.flatnonzero(x))
        labels.append(float(x[0] == x[1]))  # neither term alone tells anything
    b, w, v = X.fit(docs, np.array(labels), 20, epochs=40)
    m = X.Machine(b, w, v, {})
    right = np.mean([(m.logit(d) > 0) == y for d, y in zip(docs, labels)])
    assert right > 0.95


def corpus(n=700):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randrange(3, 9)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(30, 200))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["Idiot!", "SCUM", "lowzq" + word()])  # a stem with new endings
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    out = X.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    want = dict(labels)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, want[r.doc_id]) for r in out if r.held_out]
    assert sum(p and y for p, y in held) >= 0.9 * sum(y for _, y in held)
    assert not any(p and not y for p, y in held)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = corpus(300)
    schema, own = "doc_id long, text string, lang string, source string", "doc_id long, toxic int"
    one = X.toxicity(spark.createDataFrame([(*d, "en", "a") for d in docs], schema), spark.createDataFrame(labels, own))
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    two = X.toxicity(spark.createDataFrame([(*d, "de", "b") for d in docs], schema), spark.createDataFrame(flipped, own))
    scores = [{r.doc_id: r.score for r in x.collect()} for x in (one, two)]
    assert scores[0].keys() == scores[1].keys() and all(abs(scores[0][k] - scores[1][k]) < 1e-9 for k in scores[0])


def test_every_term_that_passes_has_a_weight_and_scores_are_the_pair_sums(spark):
    """3,000 terms, each in toxic texts only; scores are recomputed pair by pair."""
    names = [f"{'abcdefghij'[i // 100 % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i % 10]}{'efg'[i // 1000]}qx" for i in range(3000)]
    docs = [(i, " ".join(names[k] for k in range(i % 60, 3000, 60))) for i in range(2400)] + [(i, f"calm day number {i}") for i in range(2400, 12000)]
    texts = spark.createDataFrame([(i, f"{t} no{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}") for i, t in docs], "id long, text string")
    machine = X.train(texts, spark.createDataFrame([(i, int(i < 2400)) for i, _ in docs], "id long, toxic int"), sample=300)
    places = {n: X.term_hashes(n)[0] for n in names}
    assert all(p in machine.index for p in places.values()) and len(set(places.values())) > 2900
    assert all(0 <= p < X.SPACE for p in machine.index)

    sample = [t for _, t in docs[:40:7]] + ["", "no terms here", names[0], f"{names[0]} {names[1].upper()}, {names[0]}!"]
    got = [r.score for r in X.score(spark.createDataFrame(list(enumerate(sample)), "id long, text string"), machine).orderBy("id").collect()]
    for text, score in zip(sample, got):
        words = {"".join(c for c in w if c.isalpha()).lower() for w in text.split()} - {""}
        rows = sorted({machine.index[h] for w in words for h in X.term_hashes(w) if h in machine.index})
        logit = machine.intercept + sum(machine.weights[i] for i in rows)
        logit += sum(float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(rows) for b in rows[:n])
        assert abs(score - 1 / (1 + np.exp(-np.clip(logit, -35, 35)))) < 1e-9


def test_messy_rows(spark, messy, none, messy_list):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (999, 1), (20, 0), (21, 1), (22, 0), (23, 1)], "doc_id long, toxic int")
    out = X.toxicity(messy, labels)
    assert out.count() == len(messy_list) and set(messy.columns) < set(out.columns)
    assert out.where("score is null or predicted is null or held_out is null").count() == 0
    assert X.toxicity(none, labels).count() == 0
    flat = X.toxicity(messy, labels.where("false"))  # no labels: one score for all
    assert flat.select("score").distinct().count() == 1 and flat.where("predicted = 1").count() == 0
