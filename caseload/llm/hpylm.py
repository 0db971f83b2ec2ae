"""Language-model scoring by a hierarchical Pitman-Yor model.

Tokens are words; the context of a token is the word before it, one of ``PLACES`` restaurants by its hash, or the
start of a text. The restaurants of words of one class (a hash of their last two bytes, ``CLASSES`` of them) share a
parent, the restaurant of their class; all classes share the restaurant of all words, which draws from a base measure
over the known words and one unknown word. Seating is sampled by Gibbs: in each sweep the customers of every
(context, word) are seated anew given the parent's probability, tables send customers to the class, its tables
to the restaurant of all words. Scores use the seating averaged over the last sweeps, so they come from averaged
predictive probabilities and sum to one over all words and the unknown word.

Layout. A part is a split of the input (about ``PART_BYTES`` of text). A part sends, for each bucket of the
word space, one block with its distinct words, contexts and training counts. A bucket merges the blocks
of all parts, so it has all counts of its words; sweeps run bucket by bucket, and only the restaurants'
totals (two numbers a place, so ``PLACES`` bounds them) meet in between, added up by range of places. The answers (a count for each word, a log probability
for each context of it) go back as one block per part and bucket, and each part scores its texts. Blocks
instead of rows keep the traffic at some ten bytes for each distinct word of a part.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from copy import copy

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import discard, rereadable, stash

CLASSES = 32
CONTEXTS = CLASSES + 1  # restaurants of classes; the last: start of a text
OF_CLASS = 1 << 15  # places of a class
PLACES = CLASSES * OF_CLASS  # restaurants of words; one more, of the last class, is the start of a text
SHARE = 1 << 14  # places whose totals are added up together
GRID = 2.0 ** 20  # totals are added up in whole multiples of 1 / GRID, so in any order
PART_BYTES = 18 << 20
STRENGTH = 1.0  # of every restaurant
PASSES = 3  # over all buckets, exchanging totals
INNER = 3  # sweeps of a bucket in a pass
SAMPLES = 5  # averaged sweeps of the last pass
EXACT = 48  # customers seated one by one; later ones in steps of at most 2 %

BLOCK = "part long, bucket int, data binary"


class Digest:
    """Distinct words of some texts (in bucket order), distinct (word, context) entries, and the entry of every token."""

    def __init__(self, texts: list[str | None], buckets: int):
        import xxhash

        index: dict = defaultdict()
        index.default_factory = index.__len__
        end = index[b""]  # no word is empty
        codes, lengths = [], []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            codes.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            codes.append(np.array([end], np.int32))
            lengths.append(len(words) + 1)
        token = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64) if lengths else np.zeros(0, np.int64)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))
        places = np.fromiter((zlib.crc32(w[-2:]) % CLASSES for w in index), np.int64, len(index)) * OF_CLASS
        places += (hashes >> np.uint64(40)).astype(np.int64) % OF_CLASS
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        context = np.empty(len(token), np.int64)
        context[1:] = places[token[:-1]]
        context[self.starts] = PLACES
        entries, self.entry = np.unique(rank[token] * (2 * PLACES) + context, return_inverse=True)
        self.hashes, self.bucket = hashes[order], bucket[order]
        self.word, self.context = np.divmod(entries, 2 * PLACES)

    def blocks(self, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(bucket, block of its words, contexts and counts)."""
        edges = np.flatnonzero(np.r_[True, np.diff(self.bucket) > 0, True])
        for a, b in zip(edges[:-1], edges[1:]):
            lo, hi = np.searchsorted(self.word, [a, b])
            yield int(self.bucket[a]), pack(self.hashes[a:b], self.word[lo:hi] - a, self.context[lo:hi], counts[lo:hi])


def pack(hashes: np.ndarray, word: np.ndarray, context: np.ndarray, *values: np.ndarray) -> bytes:
    """Words (sorted by hash), entries sorted by word, and a value for each entry (arrays of 4 or 8 bytes an item).

    Hashes and a word's contexts are stored as differences, numbers byte by byte of equal weight: what is mostly zero compresses."""
    head = np.array([len(hashes), len(word), len(values)], "<i8").tobytes()
    steps = np.diff(hashes.astype("<u8"), prepend=np.zeros(1, "<u8"))
    apart = np.diff(context, prepend=0)
    if len(word):
        first = np.flatnonzero(np.r_[True, np.diff(word) != 0])
        apart[first] = context[first]
    body = [steps.view("u1").reshape(len(steps), 8).T.tobytes(), np.bincount(word, minlength=len(hashes)).astype("<u4").tobytes(),
            apart.astype("<i4").view("u1").reshape(len(apart), 4).T.tobytes()]
    for v in values:
        body.append(v.astype("<f4" if v.dtype.kind == "f" else "<i8").reshape(-1).view("u1").reshape(len(v), -1).T.tobytes())
        head += b"f" if v.dtype.kind == "f" else b"i"
    return zlib.compress(head + b"".join(body), 1)


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    raw = zlib.decompress(data)
    words, entries, values = (int(x) for x in np.frombuffer(raw, "<i8", 3))
    kinds, at = raw[24:24 + values], 24 + values
    out = []
    for size, kind in ((words * 8, "<u8"), (words * 4, "<u4"), (entries * 4, "u1")):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    hashes, counts, apart = out
    apart = np.ascontiguousarray(apart.reshape(4, entries).T).reshape(-1).view("<i4")
    context, some = np.cumsum(apart, dtype=np.int64), counts[counts > 0]
    first = np.cumsum(some, dtype=np.int64) - some
    context -= np.repeat(context[first] - apart[first], some)
    hashes = np.cumsum(np.ascontiguousarray(hashes.view("u1").reshape(8, words).T).reshape(-1).view("<u8"), dtype=np.uint64)
    more = []
    for k in kinds:
        kind = "<f4" if k == ord("f") else "<i8"
        size = np.dtype(kind).itemsize
        flat = np.frombuffer(raw, "u1", entries * size, at).reshape(size, entries).T
        more.append(np.ascontiguousarray(flat).reshape(-1).view(kind))
        at += entries * size
    return hashes, np.repeat(np.arange(words), counts), context, *more


def by_class(word: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and class of every (word, class) of entries sorted by word and place, and the one of each entry."""
    key = word * 64 + place // OF_CLASS
    new = np.r_[True, np.diff(key) != 0] if len(key) else np.zeros(0, bool)
    return key[new] >> 6, key[new] & 63, np.cumsum(new) - 1


def in_parts(docs: DataFrame, buckets_of_split: int) -> DataFrame:
    """id, text, learn, part of ``docs`` (id, text, learn). A part is a split of the scan, or a share of one."""
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets_of_split).cast("long"))
    return docs.select("id", "text", "learn", (F.spark_partition_id().cast("long") * buckets_of_split + share).alias("part"))


def requests(parts: DataFrame, buckets: int) -> DataFrame:
    """One block per part and bucket: distinct words, contexts, and the counts of learning texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:  # texts of a part may come in several batches; a part is small
            for part, rows in batch.groupby("part", sort=False):
                texts, learn = held.setdefault(int(part), ([], []))
                texts.extend(rows["text"])
                learn.extend(rows["learn"])
        for part in list(held):
            texts, learn = held.pop(part)
            digest = Digest(texts, buckets)
            counts = np.bincount(digest.entry, np.repeat(np.array(learn, float), digest.lengths), len(digest.word)).astype(np.int64)
            done = list(digest.blocks(counts))
            yield pd.DataFrame({"part": part, "bucket": [b for b, _ in done], "data": [x for _, x in done]})

    return parts.select("text", "learn", "part").mapInPandas(run, BLOCK)


# --- counts of a bucket -------------------------------------------------------------------------------

#: Statistics of a bucket: words, tokens, words seen once and twice, (word, class) with one and two places, then by class customers and
#: tables, if one table stands for each entry; then entries seen once and twice.
HEAD = 6


def _merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    hashes, context, counts = [], [], []
    for data in frame["data"]:
        h, word, u, c = unpack(data)
        seen = c > 0
        hashes.append(h[word[seen]])
        context.append(u[seen])
        counts.append(c[seen])
    h, u, c = np.concatenate(hashes), np.concatenate(context), np.concatenate(counts)
    order = np.lexsort((u, h))
    h, u, c = h[order], u[order], c[order]
    new = np.flatnonzero(np.r_[True, (np.diff(h) != 0) | (np.diff(u) != 0)]) if len(h) else np.zeros(0, np.int64)
    c = np.add.reduceat(c, new) if len(h) else c
    h, u = h[new], u[new]
    words, word = np.unique(h, return_inverse=True)
    total = np.bincount(word, c, len(words))
    _, k, at = by_class(word, u)
    g = np.bincount(at, minlength=len(k))
    stats = np.r_[len(words), c.sum(), (total == 1).sum(), (total == 2).sum(), (g == 1).sum(), (g == 2).sum(),
                  np.bincount(k, g, CONTEXTS), np.bincount(k, minlength=CONTEXTS), (c == 1).sum(), (c == 2).sum()]
    return pd.DataFrame({"bucket": [key[0]], "data": [pack(words, word, u, c)], "stats": [stats.astype(float)]})


def _totals(stats: DataFrame, length: int) -> np.ndarray:
    """Elementwise sum of the column stats (arrays of ``length``)."""
    rows = stats.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(length)
    for r in rows:
        out[r.i] = r.x
    return out


def _shares(total: np.ndarray) -> pd.DataFrame:
    """``total`` by ranges of ``SHARE`` numbers, those that hold one."""
    parts = [(i, total[i * SHARE:(i + 1) * SHARE]) for i in range(-(-len(total) // SHARE))]
    return pd.DataFrame([(i, zlib.compress(np.rint(x * GRID).astype("<i8").tobytes(), 1)) for i, x in parts if x.any()], columns=["share", "sums"])


def _gathered(shares: DataFrame, length: int) -> np.ndarray:
    """Sum of the arrays of ``length`` whose ranges are the rows (share, sums); a range is added up in one task."""
    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), "<i8") for x in frame["sums"])
        return pd.DataFrame({"share": [key[0]], "sums": [zlib.compress(total.tobytes(), 1)]})

    out = np.zeros(length)
    for r in shares.where("share IS NOT NULL").groupBy("share").applyInPandas(add, "share int, sums binary").collect():
        x = np.frombuffer(zlib.decompress(r.sums), "<i8")
        out[r.share * SHARE:r.share * SHARE + len(x)] = x / GRID
    return out


def _first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Customers, then entries of every place over a task's buckets."""
    total = np.zeros(2 * (PLACES + 1))
    for batch in batches:
        for data in batch["data"]:
            _, _, u, c = unpack(data)
            total += np.r_[np.bincount(u, c, PLACES + 1), np.bincount(u, minlength=PLACES + 1)]
    yield _shares(total)


# --- seating ------------------------------------------------------------------------------------------

class Model:
    """Discounts, base measure and the restaurants' totals: of classes, and of words by place."""

    def __init__(self, stats: np.ndarray, places: np.ndarray | None = None, seen: tuple = (0.0, 0.0)):
        self.place_customers, self.place_tables = np.zeros((2, PLACES + 1)) if places is None else places.reshape(2, -1)
        self.place_discount = float(np.clip(seen[0] / max(1.0, seen[0] + 2 * seen[1]), 0.1, 0.95))
        self.words, self.tokens, once, twice, e1, e2 = stats[:HEAD]
        self.customers = stats[HEAD:HEAD + CONTEXTS]
        self.tables = stats[HEAD + CONTEXTS:HEAD + 2 * CONTEXTS].copy()
        self.discount = float(np.clip(e1 / max(1.0, e1 + 2 * e2), 0.1, 0.95))
        self.parent_discount = float(np.clip(once / max(1.0, once + 2 * twice), 0.1, 0.95))
        self.new_words = once / max(1.0, self.tokens)  # share of tokens that were new: Good-Turing
        self.parent_tables = self.words
        self.settle()

    def settle(self) -> None:
        """What follows from the totals: weights of the parent and the base measure of the unknown word."""
        self.place_back_off = (STRENGTH + self.place_discount * self.place_tables) / (STRENGTH + self.place_customers)
        self.back_off = (STRENGTH + self.discount * self.tables) / (STRENGTH + self.customers)
        self.parent_customers = float(self.tables.sum())
        self.parent_new = (STRENGTH + self.parent_discount * self.parent_tables) / (STRENGTH + self.parent_customers)
        beyond = np.bincount(np.arange(PLACES + 1) // OF_CLASS, self.place_back_off * self.place_customers, CONTEXTS)  # leave the words of a class
        mean = float((self.back_off * beyond).sum() / max(1.0, self.tokens)) if self.tokens else 1.0
        self.unknown = float(np.clip(self.new_words / max(1e-12, mean * self.parent_new), 1.0 / (self.words + 1.0), 0.99)) if self.words else 1.0
        self.known = (1.0 - self.unknown) / max(1.0, self.words)

    def without(self, *names: str) -> Model:
        """A copy for tasks that need no such arrays."""
        out = copy(self)
        for n in names:
            setattr(out, n, None)
        return out

    def update(self, totals: np.ndarray) -> None:
        """Totals of a pass: tables of places, tables of classes, tables of all words."""
        self.place_tables, self.tables = totals[:PLACES + 1], totals[PLACES + 1:-1]
        self.customers = np.bincount(np.arange(PLACES + 1) // OF_CLASS, self.place_tables, CONTEXTS)
        self.parent_tables = float(totals[-1])
        self.settle()

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers and tables."""
        return (customers - self.parent_discount * tables) / (STRENGTH + self.parent_customers) + self.parent_new * self.known


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables at which ``customers`` of one dish sit, seated in turn: a new table with probability
    weight / (weight + seated - discount * tables). After ``EXACT`` customers, steps of up to 2 % are binomial."""
    tables = np.minimum(customers, 1).astype(float)
    order = np.flatnonzero(customers > 1)  # one customer has one table
    order = order[np.argsort(-customers[order], kind="stable")]
    c, w, t = customers[order], weight[order], tables[order]
    for i in range(1, EXACT):
        n = int(np.searchsorted(-c, -i, side="left"))  # those with more than i customers
        if not n:
            break
        t[:n] += rng.random(n) < w[:n] / (w[:n] + i - discount * t[:n])
    n, i = int(np.searchsorted(-c, -EXACT, side="left")), EXACT
    while n:
        step = np.minimum(max(1, i // 50), c[:n] - i).astype(np.int64)
        t[:n] += rng.binomial(step, w[:n] / (w[:n] + i - discount * t[:n]))
        i += max(1, i // 50)
        n = int(np.searchsorted(-c, -i, side="left"))
    tables[order] = t
    return tables


def sweeps(data: bytes, model: Model, seed: int, burn: int, keep: int) -> tuple[tuple, tuple, list]:
    """Gibbs sweeps of a bucket: its arrays, word and class of every (word, class), and means of the tables of entries, of
    customers and tables of each (word, class), and of customers and tables of the parent."""
    hashes, word, place, c = arrays = unpack(data)
    rng = np.random.default_rng(seed)
    of, k, at = by_class(word, place)
    many = np.flatnonzero(c > 1)
    seats, to, room = c[many], at[many], (STRENGTH + model.place_discount * model.place_tables)[place[many]]
    entries = guests = np.bincount(at, minlength=len(k)).astype(float)
    tables = np.minimum(guests, 1)
    up = np.bincount(of, tables, len(hashes))
    above = np.minimum(up, 1)
    sums = [np.zeros(len(x)) for x in (many, k, k, hashes, hashes)]
    for sweep in range(burn + keep):
        base = model.parent(up, above)[of]
        p = (guests - model.discount * tables) / (STRENGTH + model.customers[k]) + model.back_off[k] * base
        low = seat(seats, room * p[to], model.place_discount, rng)
        guests = entries + np.bincount(to, low - 1, len(k))
        tables = seat(guests.astype(np.int64), (STRENGTH + model.discount * model.tables)[k] * base, model.discount, rng)
        up = np.bincount(of, tables, len(hashes))
        above = seat(up.astype(np.int64), np.full(len(hashes), (STRENGTH + model.parent_discount * model.parent_tables) * model.known), model.parent_discount, rng)
        if sweep >= burn:
            for s, x in zip(sums, (low, guests, tables, up, above)):
                s += x / keep
    low = np.ones(len(c))
    low[many] = sums[0]
    return arrays, (of, k), [low, *sums[1:]]


SEATED = "bucket int, data binary, low binary, share int, sums binary"


def _sweep(model: Model, turn: int, last: bool):
    model = model.without("place_customers", "place_back_off")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACES + 1 + CONTEXTS + 1)
        for batch in batches:
            for bucket, data in zip(batch["bucket"], batch["data"]):
                (h, word, u, c), (of, k), (low, guests, tables, up, above) = sweeps(data, model, bucket * 1009 + turn, INNER - 1 if not last else INNER, 1 if not last else SAMPLES)
                total += np.r_[np.bincount(u, low, PLACES + 1), np.bincount(k, tables, CONTEXTS), above.sum()]
                if last:
                    count = np.bincount(word, c, len(h)).astype(np.int64)
                    own = pack(np.zeros(len(h), np.uint64), word, u, (c - model.place_discount * low).astype("f4"), count[word])
                    kept = pack(h, of, k, *(x.astype("f4") for x in (guests, tables, up[of], above[of])))
                    yield pd.DataFrame({"bucket": [bucket], "data": [kept], "low": [own], "share": pd.array([None], "Int32"), "sums": [None]})
        shares = _shares(total)
        none = [None] * len(shares)
        yield pd.DataFrame({"bucket": pd.array(none, "Int32"), "data": pd.Series(none, dtype=object), "low": pd.Series(none, dtype=object), "share": shares["share"], "sums": shares["sums"]})

    return run


# --- answers and scores -------------------------------------------------------------------------------

def _checksum(hashes: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(hashes.astype("<u8").tobytes()) << 16 ^ len(hashes)], np.uint64)


def _answers(model: Model):
    model = model.without("place_tables")

    def run(key: tuple, asked: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(bucket):
            h, of, k, g, t, up, above = unpack(bucket["data"].iloc[0])
            first = np.searchsorted(of, np.arange(len(h)))
            parent = model.parent(up[first].astype(float), above[first].astype(float)) if len(h) else np.zeros(0)
            kinds, inside = of * 64 + k, (g - model.discount * t) / (STRENGTH + model.customers[k])
            _, word, u, low, counts = unpack(bucket["low"].iloc[0])
            count = counts[np.searchsorted(word, np.arange(len(h)))] if len(h) else counts
            places, below = word * (2 * PLACES) + u, low / (STRENGTH + model.place_customers[u])
        for part, data in zip(asked["part"], asked["data"]):
            ah, aw, au, _ = unpack(data)
            n, p = np.zeros(len(ah), np.int64), np.full(len(ah), model.parent_new * model.unknown)
            kind, own, shared = au // OF_CLASS, np.zeros(len(aw)), np.zeros(len(aw))
            if len(bucket) and len(h):
                at = np.minimum(np.searchsorted(h, ah), len(h) - 1)
                hit = h[at] == ah
                n[hit], p[hit] = count[at[hit]], parent[at[hit]]
                for to, keys, values, want in ((own, places, below, at[aw] * (2 * PLACES) + au), (shared, kinds, inside, at[aw] * 64 + kind)):
                    e = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                    met = hit[aw] & (keys[e] == want)
                    to[met] = values[e[met]]
            log_p = np.log10(own + model.place_back_off[au] * (shared + model.back_off[kind] * p[aw]))
            # the part knows its words; a checksum of them and the two values of each entry are enough
            nothing = np.zeros(len(aw), np.int64)
            out.append((part, key[0], pack(_checksum(ah), nothing, nothing, n[aw], log_p.astype("f4"))))
        return pd.DataFrame(out, columns=["part", "bucket", "data"])

    return run


SCORED = "id long, n_tokens long, n_known long, base_score double, score double"


def _score(model: Model, buckets: int):
    def run(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        digest = Digest(list(docs["text"]), buckets)
        blocks = [unpack(x) for x in answers.sort_values("bucket")["data"]]
        edges = np.flatnonzero(np.r_[True, np.diff(digest.bucket) > 0, True])
        own = [int(_checksum(digest.hashes[a:b])[0]) for a, b in zip(edges[:-1], edges[1:])]
        if own != [int(b[0][0]) for b in blocks]:
            raise ValueError("a part has other texts than when it was counted; write the documents to a table first")
        count = np.concatenate([b[3] for b in blocks])[digest.entry].astype(float)
        log_p = np.concatenate([b[4] for b in blocks]).astype(float)[digest.entry]
        base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
        total = lambda x: np.add.reduceat(x, digest.starts)
        return pd.DataFrame({"id": docs["id"].astype("Int64").to_numpy(), "n_tokens": digest.lengths, "n_known": total((count > 0).astype(np.int64)),
                             "base_score": total(base), "score": total(log_p)})

    return run


def learns(id_col: str, folds: int = 5, fold: int = 1) -> Column:
    """The training rows: crc32 of the id's text, modulo ``folds``, is not ``fold``; a null id learns."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds != fold, F.lit(True))


def fit(blocks: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the seated buckets (bucket, data) from all parts' blocks."""
    merged = stash(blocks.groupBy("bucket").applyInPandas(_merge, "bucket int, data binary, stats array<double>"), "hpy-counts")
    stats = _totals(merged, HEAD + 2 * CONTEXTS + 2)
    model = Model(stats[:-2], _gathered(merged.select("data").mapInPandas(_first, "share int, sums binary"), 2 * (PLACES + 1)), tuple(stats[-2:]))
    for turn in range(PASSES + 1):
        last = turn == PASSES
        seated = merged.select("bucket", "data").mapInPandas(_sweep(model, turn, last), SEATED)
        if last:
            seated = stash(seated, "hpy-seated")
        model.update(_gathered(seated.select("share", "sums"), PLACES + 1 + CONTEXTS + 1))
    discard(merged)
    kept = seated.where("data IS NOT NULL").select("bucket", "data", "low")
    kept._stash_path = seated._stash_path
    return model, kept


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Learns from the rows that are not held out; tokens are ASCII-lower-cased words and one end. Null and
    empty texts are the end alone; null ids learn and are scored; repeated rows count each; an empty table
    gives no rows; other columns are ignored. ``docs`` is read twice (a copy of it, if it is not a scan);
    a part that holds other texts the second time is noticed and raises ValueError."""
    learn = learns(id_col, folds, fold)
    given = rereadable(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), "hpy-documents")
    rows = given.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), learn.alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splits = max(1, rows.rdd.getNumPartitions())
    buckets = max(8, -(-size // PART_BYTES))
    parts = in_parts(rows, max(1, round(size / splits / PART_BYTES)))
    asked = stash(requests(parts, buckets), "hpy-blocks")
    model, seated = fit(asked)
    answers = stash(asked.groupBy("bucket").cogroup(seated.groupBy("bucket")).applyInPandas(_answers(model), BLOCK), "hpy-answers")
    discard(asked, seated)
    scored = parts.select("id", "text", "part").groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(_score(model, buckets), SCORED)
    return scored.select(F.col("id").alias(id_col), (~learns("id", folds, fold)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(int(model.tokens)).cast("long").alias("train_tokens"), "base_score", "score")
