"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct lower-cased letter runs and their first four and five letters (so an
inflected or compounded insult counts as its stem does), hashed into ``SPACE`` places; words of one place are
one term. Every labelled training document is counted: each term's documents and toxic documents, equal texts
once. Every term that differs from the base rate by ``LEAST_Z`` standard errors gets a weight and a
factor vector; the machine adds to the linear weights the inner products of the factors of every two
terms of a document, so a term can count for more (or less) beside another. However many words the texts
hold, there are at most ``SPACE`` counts and weights.

The machine is fitted on a bounded sample: about ``SAMPLE`` training texts of each label (all, if there are
fewer), chosen by hash.
The intercept is then moved to the label's share among all training texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import discard, stash

SPACE = 1 << 20
LEAST_Z = 4.0
LEAST_DOCS = 3
SAMPLE = 10_000
FACTORS = 8
EPOCHS = 30
SENT_LABELS = 2_000_000  # labels are sent to every task up to this number of rows, else joined by shuffle
THRESHOLD = 0.7
CACHED_WORDS = 150_000

_LETTERS = re.compile(r"[^\W\d_]+")


def term_hashes(word: str) -> tuple[int, ...]:
    import xxhash

    names = ["w" + word] + [f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n]
    return tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) % SPACE for x in names)


class Terms(dict):
    """Word -> what ``of`` makes of it; bounded."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: str):
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = out = self.of(word)
        return out

    def set_of(self, text: str | None) -> set[int]:
        return {h for hs in map(self.__getitem__, set(_LETTERS.findall(text.lower()))) for h in hs} if text else set()


@dataclass
class Machine:
    """Intercept, weights and factors of the terms in ``index`` (hash -> row)."""

    intercept: float
    weights: np.ndarray
    factors: np.ndarray
    index: dict[int, int]

    def terms(self) -> Terms:
        index = self.index
        return Terms(lambda word: tuple(i for h in term_hashes(word) if (i := index.get(h)) is not None))

    def logit(self, rows: np.ndarray) -> float:
        v = self.factors[rows]
        return self.intercept + self.weights[rows].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum())


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(docs: list[np.ndarray], labels: np.ndarray, terms: int, epochs: int = EPOCHS, factors: int = FACTORS,
        batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss, Adam with weight decay. ``docs``: the term rows of each document."""
    rng = np.random.default_rng(seed)
    theta = [np.zeros(1), np.zeros(terms), rng.normal(0, 0.02, (terms, factors))]
    first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    step = 0
    for _ in range(epochs if len(docs) else 0):
        for part in np.array_split(rng.permutation(len(docs)), -(-len(docs) // batch)):
            sizes = np.array([len(docs[i]) for i in part])
            rows = np.concatenate([docs[i] for i in part]).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(part)), sizes)
            v = theta[2][rows]
            total = np.zeros((len(part), factors))
            np.add.at(total, owner, v)
            pairs = 0.5 * ((total ** 2).sum(axis=1) - np.bincount(owner, (v ** 2).sum(axis=1), len(part)))
            error = (sigmoid(theta[0][0] + np.bincount(owner, theta[1][rows], len(part)) + pairs) - labels[part]) / len(part)
            grad = [np.array([error.sum()]), np.bincount(rows, error[owner], terms), np.zeros_like(theta[2])]
            np.add.at(grad[2], rows, error[owner][:, None] * (total[owner] - v))
            step += 1
            for x, g, m, s in zip(theta, grad, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8) + rate * decay * x
    return float(theta[0][0]), theta[1], theta[2]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    terms, n, t = Terms(term_hashes), Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            found = terms.set_of(text)
            n.update(found)
            if toxic:
                t.update(found)
        if len(n) > 150_000:
            yield _count_frame(n, t)
            n, t = Counter(), Counter()
    if n:
        yield _count_frame(n, t)


def _count_frame(n: Counter, t: Counter) -> pd.DataFrame:
    return pd.DataFrame({"term": np.fromiter(n, np.int64, len(n)), "n": np.fromiter(n.values(), np.int64, len(n)), "t": [t[k] for k in n]})


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic (0/1), order: distinct texts of labelled rows of ``docs`` (id, text); ``labels``: id, toxic."""
    marks = labels.where(F.col("id").isNotNull() & F.col("toxic").isNotNull()).groupBy("id").agg(F.avg("toxic").alias("toxic"))
    marks = F.broadcast(marks) if labels.count() <= SENT_LABELS else marks
    texts = docs.join(marks, "id").where(F.length("text") > 0).groupBy(F.xxhash64("text").alias("order")).agg(
        F.first("text").alias("text"), F.avg("toxic").alias("toxic"))
    return stash(texts.select("order", "text", (F.col("toxic") >= 0.5).cast("int").alias("toxic")), "toxic-training")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_z: float = LEAST_Z) -> Machine:
    """Fit on the labelled rows of ``docs`` (id, text); ``labels``: id, toxic. No labels: a constant score of the half."""
    texts = training_texts(docs, labels)
    totals = texts.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = totals["n"] or 0, totals["t"] or 0
    if not n or t in (0, n):
        share = (t + 0.5) / (n + 1.0)
        return Machine(float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)), {})
    base = t / n
    counted = texts.mapInPandas(_counts, "term long, n long, t long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    z = F.abs(F.col("t") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)) + 0.5)
    best = counted.where(F.col("n") >= LEAST_DOCS).withColumn("z", z).where(F.col("z") >= least_z)
    index = {r.term: i for i, r in enumerate(best.orderBy(F.desc("z"), "term").collect())}
    machine = Machine(0.0, np.zeros(len(index)), np.zeros((len(index), FACTORS)), index)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = machine.terms()
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "rows": [sorted(terms.set_of(x)) for x in batch["text"]]})

    # the sample: hashes are uniform, so a bound on them keeps about ``sample`` texts of each label, wherever they are
    bound = lambda size: min((1 << 63) - 1, int(-(1 << 63) + min(1.0, sample / size) * (1 << 64)))
    chosen = texts.where(F.col("order") <= F.when(F.col("toxic") == 1, F.lit(bound(t))).otherwise(F.lit(bound(n - t))))
    got = chosen.mapInPandas(rows_of, "toxic int, rows array<int>").collect()
    discard(texts)
    y = np.array([r.toxic for r in got], float)
    intercept, weights, factors = fit([np.array(r.rows, np.int64) for r in got], y, len(index))
    # the sample may hold the labels in other shares than the training texts
    shift = np.log(t / (n - t)) - np.log(y.sum() / (len(y) - y.sum()))
    return Machine(intercept + float(shift), weights, factors, index)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1 of every whole text (null and empty: that of no terms)."""
    names = [c for c in docs.columns if c != out_col]
    sent = docs.sparkSession.sparkContext.broadcast((machine.intercept, machine.weights, machine.factors, machine.index))
    source = docs.select(*[F.col(f"`{c}`") for c in names])

    def run(batches):
        import pyarrow as pa

        model = Machine(*sent.value)
        terms = model.terms()
        for batch in batches:
            logits = [model.logit(np.fromiter(terms.set_of(x), np.int64)) for x in batch.column(names.index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(np.array(logits, float)), pa.float64())], [*names, out_col])

    return source.mapInArrow(run, source.withColumn(out_col, F.lit(0.0)).schema)


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id's text, modulo ``folds``, is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``threshold``).

    Learns from the labels of rows that are not held out. Null and empty texts are scored as texts
    without terms; labels without a document, null labels and null ids teach nothing; several labels of
    a document are averaged; rows that repeat are scored each; columns of ``docs`` named like the new
    ones are replaced."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")]
    teach = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(~held_out("id"))
    machine = train(teach, labels.select(F.col(f"`{id_col}`").alias("id"), "toxic"))
    out = score(docs.select(*own), machine, text_col)
    return out.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
