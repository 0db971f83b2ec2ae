"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are TF-IDF passages (document frequencies count all documents). A distributed randomised
singular value decomposition of the passages gives a latent space: hashed Gaussian test vectors, one power
step, orthonormalisation, and an eigenproblem of a small matrix. Items of up to
16, 64, 256 ... words have windows of twice as many words, so that a copy lies whole in one of them. Every window of every document is
folded into that space and compared by cosine with all items, in blocks of items. Windows above ``COSINE``
are candidates; a candidate counts if the longest common subsequence of words covers ``LCS`` of the item,
its shared words carry ``WEIGHT`` of the item's IDF mass, and ``ANSWER`` of the words of the item's last
sentence occur in it. Small changes of wording, case, punctuation or line breaks thus still match.

The cosine divides by the norms over the block's terms: words of no item, and thus the number of documents,
have no say. A window's norm counts as at least the item's and at most ``ROOM`` times it, so a window that holds
``COSINE`` times ``ROOM`` of an item's squared norm is a candidate, whatever else stands in it. Documents are only
mapped, never shuffled: all that is sent to the tasks belongs to a block of at most ``ITEMS`` items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import stash

STRIDE = 16  # least stride; a window is two strides
GROWTH = 4  # of one stride to the next
RANK, EXTRA = 192, 16
ITEMS = 256  # in a block; the latent space keeps nearly all of so few passages
COSINE = 0.3
ROOM = 2 ** 0.5
LCS = 0.6
WEIGHT = 0.55
ANSWER = 0.5
CHARS = 400_000  # of texts whose windows are compared at once

_WORD = re.compile(r"[^\W_]+")
MATCH = "array<struct<item_id:bigint,cosine:double,lcs:double,weight:double,answer:double>>"


#: ASCII characters that are no letters or digits become spaces; the bytes of other characters stay.
_TO_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    """``_WORD.findall`` of the lower-cased text: split at ASCII separators first, the expression only where other
    characters are."""
    if not text:
        return []
    text = text.lower()
    try:
        pieces = text.encode().translate(_TO_SPACES).decode().split()
    except UnicodeEncodeError:  # lone surrogates
        return _WORD.findall(text)
    if text.isascii() or "".join(pieces).isalnum():
        return pieces
    out: list[str] = []
    for piece in pieces:
        if piece.isascii() or piece.isalnum():
            out.append(piece)
        else:
            out += _WORD.findall(piece)
    return out


def answer_words(text: str) -> set[str]:
    """Words of the last sentence that has any; an item of one sentence is its own answer."""
    parts = [w for p in re.split(r"[.!?\n]+", text) if (w := words_of(p))]
    return set(parts[-1]) if parts else set()


def gaussian(terms: np.ndarray, columns: int) -> np.ndarray:
    """Standard normal test vectors, a function of the term's hash alone."""
    x = terms.astype(np.uint64)[:, None] + np.arange(1, 2 * columns + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
    return np.sqrt(-2 * np.log(u[:, :columns] + 2.0 ** -54)) * np.cos(2 * np.pi * u[:, columns:])


class Index:
    """Terms of a block of items (word -> row) with their IDF, and the IDF of a word that no document has."""

    def __init__(self, rows: dict[str, int], idf: np.ndarray, other: float):
        self.rows, self.idf, self.other = rows, idf, other

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = Counter(words)
        at = np.array([self.rows[w] for w in n], np.int64)
        return at, np.fromiter(n.values(), float, len(n)) * self.idf[at]


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """In how many texts of ``docs`` each of the block's terms stands, and the number of texts."""
    sent = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(terms)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sent.value
        known, n, texts = rows.keys(), np.zeros(len(rows), np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                texts += 1
                found = known & set(words_of(text))
                n[[rows[w] for w in found]] += 1
        at = np.flatnonzero(n)
        yield pd.DataFrame({"term": np.r_[at, -1], "n": np.r_[n[at], texts]})

    counts, total = np.zeros(len(terms), np.int64), 0
    for row in docs.select("text").mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        if row.term < 0:
            total = row.n
        else:
            counts[row.term] = row.n
    return counts, total


def _sum_vectors(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    terms, at = np.unique(frame["term"].to_numpy(np.int64), return_inverse=True)
    vectors = np.stack(frame["vector"].to_numpy())
    out = np.zeros((len(terms), vectors.shape[1]))
    np.add.at(out, at, vectors)
    return pd.DataFrame({"term": terms, "vector": list(out)})


def randomised_svd(items: DataFrame, index: Index, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms x rank) of the TF-IDF passages of ``items`` (item_id, text), scaled to unit rows.

    Both passes run over partitions of passages; the driver holds terms x (rank + EXTRA) numbers of one block."""
    import xxhash

    spark, n = items.sparkSession, len(index.rows)
    columns = min(rank + EXTRA, n)
    hashes = np.zeros(n, np.int64)
    for w, i in index.rows.items():
        hashes[i] = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))], np.uint64).astype(np.int64)[0]
    sent = spark.sparkContext.broadcast((index.rows, index.idf, index.other, hashes))

    def power(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, idf, other, codes = sent.value
        tfidf, total = Index(rows, idf, other), {}
        for batch in batches:
            for text in batch["text"]:
                if words := words_of(text):
                    at, x = tfidf.vector(words)
                    norm = np.linalg.norm(x) or 1.0
                    y = (x / norm) @ gaussian(codes[at], columns)
                    for t, v in zip(at, x / norm):
                        total[t] = total.get(t, 0.0) + v * y
        if total:
            yield pd.DataFrame({"term": list(total), "vector": list(total.values())})

    sketch = np.zeros((n, columns))
    parts = items.select("text").mapInPandas(power, "term long, vector array<double>")
    for row in parts.groupBy(F.pmod("term", F.lit(64))).applyInPandas(_sum_vectors, "term long, vector array<double>").toLocalIterator():
        sketch[row.term] = row.vector
    basis, _ = np.linalg.qr(sketch)
    sent_basis = spark.sparkContext.broadcast(basis)

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, idf, other, _ = sent.value
        tfidf, q = Index(rows, idf, other), sent_basis.value
        out = np.zeros((q.shape[1], q.shape[1]))
        for batch in batches:
            for text in batch["text"]:
                if words := words_of(text):
                    at, x = tfidf.vector(words)
                    y = (x / (np.linalg.norm(x) or 1.0)) @ q[at]
                    out += np.outer(y, y)
        yield pd.DataFrame({"row": np.arange(len(out)), "vector": list(out)})

    small = np.zeros((basis.shape[1], basis.shape[1]))
    for row in items.select("text").mapInPandas(gram, "row long, vector array<double>").toLocalIterator():
        small[row.row] += row.vector
    values, vectors = np.linalg.eigh(small)
    return (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence by bit-parallel dynamic programming over ``a``."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def block_sums(rows: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(rows[at], starts)`` to the last bit, in a tenth of its time: the same additions in the same order (the
    first row, and to it the sum of the others, in eight strands and a tail), but of all blocks at once."""
    sizes = np.diff(np.r_[starts, len(at)])
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = starts[order], sizes[order]
    out = np.empty((len(starts), rows.shape[1]), rows.dtype)
    long = int(np.searchsorted(-sizes, -129, side="left"))  # of more than 129 rows: numpy halves them
    for i, first, size in zip(order[:long], begin[:long], sizes[:long]):
        out[i] = np.add.reduceat(rows[at[first:first + size]], [0])[0]
    order, begin, rest = order[long:], begin[long:], sizes[long:] - 1
    if not len(order):
        return out
    longer = lambda k: int(np.searchsorted(-rest, -k, side="left"))  # noqa: E731  blocks with more than k rows after the first
    row = lambda n, k: rows[at[begin[:n] + 1 + k]]
    total = np.zeros((len(order), rows.shape[1]), rows.dtype)
    if n := longer(7):
        s = [row(n, j) for j in range(8)]
        for k in range(8, int(rest[0]) - 7, 8):
            m = longer(k + 7)
            for j in range(8):
                s[j][:m] += row(m, k + j)
        total[:n] = ((s[0] + s[1]) + (s[2] + s[3])) + ((s[4] + s[5]) + (s[6] + s[7]))
    for j in range(7):
        has = np.flatnonzero(rest % 8 > j)
        total[has] += rows[at[begin[has] + 1 + rest[has] // 8 * 8 + j]]
    out[order] = rows[at[begin]] + total
    return out


class Search:
    """Windows of documents against one block of items."""

    def __init__(self, index: Index, space: np.ndarray, items: list[tuple[int, str]], limits: dict[str, float]):
        self.index, self.limits = index, limits
        self.words = [words_of(t) for _, t in items]
        self.ids, self.answers = [i for i, _ in items], [answer_words(t) for _, t in items]
        self.weights = [{w: index.idf[index.rows[w]] for w in set(ws)} for ws in self.words]
        self.space = np.vstack([space, np.zeros((1, space.shape[1]), np.float32)]) * np.r_[index.idf, 0.0].astype(np.float32)[:, None]
        self.squares = np.r_[index.idf, 0.0] ** 2
        vectors = [index.vector(ws) for ws in self.words]
        self.norms = np.array([np.linalg.norm(x) or 1.0 for _, x in vectors])
        self.items = np.array([(x / n) @ space[at] for (at, x), n in zip(vectors, self.norms)], np.float32)
        # no item is longer than its stride: two strides hold every copy whole
        self.strides = np.array([STRIDE * GROWTH ** next(k for k in range(64) if STRIDE * GROWTH ** k >= len(ws)) for ws in self.words], np.int64)
        self.most = {}  # by stride: the most that one token of a term adds to the product with any item
        for stride in np.unique(self.strides):
            most = np.zeros(len(self.squares))
            for k in np.flatnonzero(self.strides == stride):
                at, x = vectors[k]
                most[at] = np.maximum(most[at], x * index.idf[at])
            self.most[int(stride)] = most

    def candidates(self, tokens: list[list[str]]) -> Iterator[tuple[int, int, int, float]]:
        """(document, first word, item, cosine) of windows above the limit."""
        get, other = self.index.rows.get, len(self.index.rows)
        lengths = np.array([len(t) for t in tokens], np.int64)
        at = np.fromiter(map(get, chain.from_iterable(tokens), repeat(other)), np.int64, int(lengths.sum()))
        known = np.flatnonzero(at < other)
        if len(known):
            doc = np.repeat(np.arange(len(tokens)), lengths)[known]
            place, at = known - (np.cumsum(lengths) - lengths)[doc], at[known]
            for stride in self.most:
                yield from self._windows(at, doc, place, lengths, stride)

    def _windows(self, at: np.ndarray, doc: np.ndarray, place: np.ndarray, lengths: np.ndarray, stride: int) -> Iterator[tuple[int, int, int, float]]:
        """Candidates for the items of one stride; ``at``, ``doc`` and ``place`` are of the tokens that are terms."""
        items = np.flatnonzero(self.strides == stride)
        blocks = -(-lengths // stride)
        first = np.r_[0, np.cumsum(blocks)]
        n = int(first[-1])
        block, most = first[doc] + place // stride, self.most[stride][at]
        joined = np.ones(n, bool)  # a document's last block has no next one
        joined[first[1:][blocks > 0] - 1] = False
        both = lambda x: x + np.r_[x[1:], 0.0] * joined
        mass, reach = both(np.bincount(block, self.squares[at], n)), both(np.bincount(block, most, n))
        # the product with an item is at most ``reach``, and a candidate's is at least the limit times the item's squared norm
        hopeful = np.flatnonzero(reach >= self.limits["cosine"] * self.norms[items].min() ** 2 * (1 - 1e-6))
        if not len(hopeful):
            return
        needed = np.zeros(n + 1, bool)
        needed[hopeful] = True
        needed[hopeful + 1] |= joined[hopeful]
        take = np.flatnonzero((most > 0) & needed[block])  # other terms add nothing to a product with these items
        rank_of = np.cumsum(needed) - 1
        sums = np.zeros((int(needed.sum()) + 1, self.space.shape[1]), np.float32)
        if len(take):
            starts = np.flatnonzero(np.r_[True, np.diff(block[take]) > 0])
            sums[rank_of[block[take][starts]]] = block_sums(self.space, at[take], starts)
        after = np.where(joined[hopeful], rank_of[np.minimum(hopeful + 1, n)], len(sums) - 1)
        window = sums[rank_of[hopeful]] + sums[after]
        norms = self.norms[items]
        cosine = (window @ self.items[items].T) / np.clip(np.sqrt(mass[hopeful])[:, None], norms, ROOM * norms)
        for k, i in np.argwhere(cosine >= self.limits["cosine"]):
            b = int(hopeful[k])
            d = int(np.searchsorted(first, b, side="right")) - 1
            yield d, int(b - first[d]) * stride, int(items[i]), float(cosine[k, i])

    def confirm(self, tokens: list[str], start: int, item: int) -> tuple[float, float, float] | None:
        words, weights = self.words[item], self.weights[item]
        part = tokens[max(0, start - len(words)):start + 2 * int(self.strides[item]) + len(words)]
        there = set(part)
        weight = sum(x for w, x in weights.items() if w in there) / (sum(weights.values()) or 1.0)
        answer = len(self.answers[item] & there) / max(1, len(self.answers[item]))
        if weight < self.limits["weight"] or answer < self.limits["answer"]:
            return None
        lcs = lcs_length(words, part) / len(words)
        return (lcs, weight, answer) if lcs >= self.limits["lcs"] else None

    def matches(self, texts: list[str | None]) -> list[list[tuple]]:
        """(item_id, cosine, lcs, weight, answer) of the items found in each text, best window of each."""
        tokens = [words_of(t) for t in texts]
        out: list[dict[int, tuple]] = [{} for _ in texts]
        for d, start, i, cosine in self.candidates(tokens):
            if got := self.confirm(tokens[d], start, i):
                row = (self.ids[i], cosine, *got)
                out[d][i] = max(out[d].get(i, row), row, key=lambda r: (r[2], r[1]))
        return [[x[i] for i in sorted(x)] for x in out]


def _item_blocks(items: DataFrame) -> list[DataFrame]:
    """Blocks of distinct items (item_id, text), of about ``ITEMS`` rows each."""
    n = -(-items.count() // ITEMS)
    if n <= 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 rank: int = RANK, cosine: float = COSINE, lcs: float = LCS, weight: float = WEIGHT, answer: float = ANSWER, out_col: str = "matches") -> DataFrame:
    """``docs`` with a column ``out_col`` (``MATCH``): the items that each whole text contains, verbatim or reworded.

    Null and empty texts and items match nothing; repeated rows are handled each, rows of ``benchmark`` equal in
    id and text are one item; an empty table on either side gives no matches; a column of ``docs`` named ``out_col`` is replaced."""
    names = [c for c in docs.columns if c != out_col]
    source = docs.select(*[F.col(f"`{c}`") for c in names])
    out = source.withColumn(out_col, F.array().cast(MATCH))
    items = stash(benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
                  .where(F.length(F.trim("text")) > 0).distinct(), "benchmark")
    limits = {"cosine": cosine, "lcs": lcs, "weight": weight, "answer": answer}
    for block in _item_blocks(items):
        given = sorted(((r.item_id, r.text) for r in block.collect()), key=lambda x: (x[0] is None, x))  # at most about ITEMS rows
        terms = sorted({w for _, t in given for w in words_of(t)})
        given = [x for x in given if words_of(x[1])]
        if not terms:
            continue
        counts, total = document_frequencies(source.select(F.col(f"`{text_col}`").alias("text")), terms)
        index = Index({w: i for i, w in enumerate(terms)}, np.log((total + 1.0) / (counts + 0.5)).clip(0.01), float(np.log(2.0 * (total + 1.0))))
        space = randomised_svd(block, index, rank)
        sent = docs.sparkSession.sparkContext.broadcast((index.rows, index.idf, index.other, space, given))
        out = out.mapInArrow(_searcher(sent, names, text_col, limits), out.schema)
    return out


def _searcher(sent, names: list[str], text_col: str, limits: dict[str, float]):
    def run(batches):
        import pyarrow as pa

        rows, idf, other, space, given = sent.value
        search = Search(Index(rows, idf, other), space, given, limits)
        for batch in batches:
            texts, found, part, size = batch.column(names.index(text_col)).to_pylist(), [], [], 0
            for t in texts:
                part.append(t)
                size += len(t or "")
                if size > CHARS:
                    found += search.matches(part)
                    part, size = [], 0
            found += search.matches(part)
            kind = batch.schema.field(len(names)).type
            keys = ("item_id", "cosine", "lcs", "weight", "answer")
            new = [(old or []) + [dict(zip(keys, m)) for m in ms] for old, ms in zip(batch.column(len(names)).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(new, kind)], batch.schema.names)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per (row of ``docs``, item) found: id, item_id, cosine, lcs, weight, answer."""
    found = find_matches(docs, benchmark, out_col="__matches", **options).where(F.size("__matches") > 0)
    return found.select(F.col(f"`{id_col}`").alias(id_col), F.explode("__matches").alias("m")).select(id_col, "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item was found, unchanged."""
    return find_matches(docs, benchmark, out_col="__matches", **options).where(F.size("__matches") == 0).drop("__matches")
