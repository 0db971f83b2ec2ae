"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Candidates are dealt into chunks; the task of a chunk sorts its rows by each dimension. For an anchor it reads the
lists from the end that the sign of the anchor's component asks for (sorted access), scores each row it meets
for the first time by its whole integer inner product (random access), and stops once the threshold, the score
that a row at the present depth of all lists would have, falls strictly below every window's k-th score (or below
the window). Depths double. A first round finds the positives, a second the negatives of their score windows;
both merge the chunks' best rows by partial top-k windows. Anchors are sent to every chunk: a stated query set
against all rows, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.llm.common import discard, stash

#: Candidates of a chunk at most, about; and at least, where the table is small.
CHUNK_ROWS, LEAST_ROWS = 8192, 512
FIRST_DEPTH = 16
#: Sums of products below this are exact as doubles.
EXACT = 2.0 ** 53


def _long(values) -> np.ndarray:
    out = np.array([int(v) for v in values], object)
    if len(out) and (max(out) >= 2 ** 63 or min(out) < -2 ** 63):
        raise ValueError("an inner product is beyond 64 bits")
    return out.astype(np.int64)


class Lists:
    """The rows of a chunk, sorted by each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(x, self.order, 0)
        self.top = float(np.abs(x).max(initial=0.0))

    def accesses(self, a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows met for the first time, their scores, threshold) at doubling depths of sorted access; a row that is
        not met yet scores no more than the threshold."""
        n, dims = self.x.shape
        a = np.concatenate([a, np.zeros(max(0, dims - len(a)))])[:dims]  # missing components count as 0
        exact = self.top * float(np.abs(a).sum()) < EXACT
        down, up = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen, done, depth = np.zeros(n, bool), 0, min(FIRST_DEPTH, n)
        while n:
            met = np.zeros(n, bool)
            met[self.order[n - depth:n - done][:, down]] = True
            met[self.order[done:depth][:, up]] = True
            if depth == n:
                met[:] = True  # the lists are read to their ends, or the anchor is all zeros
            rows = np.flatnonzero(met & ~seen)
            seen |= met
            over = depth == n or bool(seen.all())
            if exact:
                scores = (self.x[rows] @ a).astype(np.int64)
                threshold = float(a[down] @ self.sorted[n - depth, down] + a[up] @ self.sorted[depth - 1, up])
            else:
                big = [int(v) for v in a]
                scores = _long([sum(int(v) * w for v, w in zip(r, big)) for r in self.x[rows]])
                threshold = float(sum(int(self.sorted[n - depth, d]) * big[d] for d in down) + sum(int(self.sorted[depth - 1, d]) * big[d] for d in up))
                threshold += abs(threshold) * 2.0 ** -50
            yield rows, scores, -np.inf if over else threshold
            if over:
                return
            done, depth = depth, min(n, 2 * depth)

    def positives(self, anchor: int, label: int, a: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) of other rows with the anchor's label."""
        best: list[tuple[int, int]] = []
        for rows, scores, threshold in self.accesses(a):
            own = (self.labels[rows] == label) & (self.ids[rows] != anchor)
            best = sorted([*best, *zip((-scores[own]).tolist(), self.ids[rows[own]].tolist())])[:k]
            if len(best) == k and threshold < -best[-1][0]:
                break
        return [(-s, i) for s, i in best]

    def negatives(self, label: int, a: np.ndarray, windows: list[int], k: int, low: int, high: int) -> dict[int, list[tuple[int, int]]]:
        """By positive score p: the ``k`` best (score, id) of rows of other labels with low * p <= high * score <= high * p."""
        windows = [p for p in windows if p >= 0]  # none fits a negative p
        found: dict[int, list[tuple[int, int]]] = {p: [] for p in windows}
        if not windows:
            return found
        most, least = max(windows), min(windows)
        s, i = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows, scores, threshold in self.accesses(a):
            own = self.labels[rows] != label
            own &= (scores <= most) & (scores.astype(object) * high >= low * least if most > 2 ** 55 else scores * high >= low * least)
            if own.any():
                s, i = np.concatenate([s, scores[own]]), np.concatenate([i, self.ids[rows[own]]])
            if threshold >= most:
                continue  # no window's k-th score can lie above it
            order = np.lexsort((i, -s))
            s, i = s[order], i[order]
            open_windows = False
            for p in windows:
                at = int(np.searchsorted(-s, -p, "left"))
                found[p] = [(v, j) for v, j in zip(s[at:at + k].tolist(), i[at:at + k].tolist()) if v * high >= low * p]
                open_windows |= not (len(found[p]) == k and threshold < found[p][-1][0] or threshold * high < low * p)
            if not open_windows:
                break
        return found


def _arrays(batch, name: str) -> np.ndarray:
    """The vectors of a batch as a matrix; shorter ones are filled with 0."""
    column = batch.column(name)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dims = int(sizes.max(initial=0))
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    dims = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts])


def _searched(rows: DataFrame, anchors: DataFrame, chunks: int, answer, schema: str) -> DataFrame:
    """``answer(lists, anchor id, label, vector, windows)`` for every anchor and chunk of rows (id, label, x); anchors also
    hold a ``key`` and ``windows``."""
    dealt = rows.select(F.pmod(F.xxhash64("id", "label", "x"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"), "id", "label", "x",
                        F.lit(0).cast("long").alias("key"), F.array().cast("array<bigint>").alias("windows"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("kind"), "id", "label", "x", "key", "windows")
    # each chunk's rows come first, then the anchors, which stream past them
    both = dealt.unionByName(asked).repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "kind", "id", "key")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        held, lists, now = [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, kind = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                if chunk[low] != now:
                    held, lists, now = [], None, chunk[low]
                ids, labels, x = part.column("id").to_numpy(), part.column("label").to_numpy(), _arrays(part, "x")
                if kind[low] == 0:
                    held.append((ids, labels, x))
                    continue
                if lists is None and held:
                    lists = Lists(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _stacked([h[2] for h in held]))
                    held = []
                if lists is None:
                    continue
                keys, windows = part.column("key").to_pylist(), part.column("windows").to_pylist()
                out = [(key, *r) for n, key in enumerate(keys) for r in answer(lists, ids[n], labels[n], x[n], windows[n])]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(len(names))], names)

    return both.mapInArrow(run, schema)


def mine_hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                        scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of hard negatives.

    Vectors are floor(scale * x); a score is the integer inner product. An anchor (``anchors`` is true) takes its
    first ``positives`` other rows of its label, and for each the first ``negatives`` rows of other labels with
    low * positive_score <= high * negative_score <= high * positive_score; higher scores first, then smaller ids.
    Rows without an id, label or vector, or with a null or non-finite component, take no part; rows equal in id,
    label and scaled vector count once. Rows that share an id with the anchor are not its positives; an id with several
    rows may appear more than once. Missing trailing components count as 0. Other columns are ignored, whatever
    their names. An empty table, or an anchor without positives or negatives, gives no rows. Scores must fit 64 bits.
    """
    finite = F.forall("given", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    base = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                       F.transform(F.col(f"`{vec_col}`"), lambda v: v.cast("double")).alias("given"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    base = base.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("given").isNotNull()).where(finite)
    # floor as a double: no component is too large for it
    base = base.select("id", "label", "anchor", F.transform("given", lambda v:
                                                            F.when(F.abs(v * scale) < 2.0 ** 53, F.floor(v * scale).cast("double")).otherwise(v * scale)).alias("x"))
    base = stash(base.groupBy("id", "label", "x").agg(F.max("anchor").alias("anchor")), "hardneg-rows")
    n = base.count()
    spark = rows.sparkSession
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_ROWS))
    chunks = max(1, spread, -(-n // CHUNK_ROWS))
    asking = stash(base.where("anchor").select("id", "label", "x", F.xxhash64("id", "label", "x").alias("key")), "hardneg-anchors")

    first = _searched(base, asking.withColumn("windows", F.array().cast("array<bigint>")), chunks,
                      lambda lists, i, label, a, _: lists.positives(i, label, a, positives), "key long, score long, found long")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "found")
    found = stash(first.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives), "hardneg-positives")
    windows = found.groupBy("key").agg(F.collect_set("score").alias("windows"))

    def search(lists, i, label, a, scores):
        return [(p, s, j) for p, got in lists.negatives(label, a, scores, negatives, low, high).items() for s, j in got]

    second = _searched(base, asking.join(windows, "key"), chunks, search, "key long, positive_score long, negative_score long, negative_id long")
    order = Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = found.select("key", F.col("score").alias("positive_score"), F.col("found").alias("positive_id"))
    out = stash(ranked.join(pairs, ["key", "positive_score"]).join(asking.select("key", F.col("id").alias("anchor_id")), "key"), "hardneg-found")
    discard(base, asking, found)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
