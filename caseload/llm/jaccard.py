"""Exact Jaccard join of word shingle sets by regions of projections, stars and one pass of pivot cells.

Jaccard distance is a metric, and sets link within the radius t = 1 - similarity. Distances between
unrelated texts all lie near 1, where triangle windows around document pivots exclude nothing, so the
first partition is made in projections of the space, in which the metric is coarse:

1. Projections. A size class splits the shingle space by hash into m slices. Two sets that link differ in
   at most D = n * t / (1 - t) shingles, so all but D of a set's slices are equal in both. The pivots of a
   slice are the contents that occur in it; a set lies at distance 0 from its own and at more than t from
   all others, so a Voronoi region is one content of one slice, and any D + 1 slices (largest first, in one
   global order) must meet a linked set in a region. Sets near the lower edge of their class are
   replicated to the class below. Small classes use pairs of shingles instead of slices.
2. Stars. The best connected set of a region is its pivot; every set is compared with the pivot it
   shares most regions with. Components of the links found close most regions at once.
3. Cells. The sets of the regions that still hold several components form the Voronoi cells of their
   pivots. All of a cell are compared with its pivot p, and the join is repeated inside the cell in
   coordinates that start at p: there near copies differ by their few changes alone, most of which no
   other set of the cell shares. Triangle-inequality windows, the prefix rule and the positional rule on
   these differences leave only pairs that may link (``_cell_pairs``), which are compared exactly.

Equal sets are one set throughout. Comparisons are exact on 64-bit shingle hashes. A pair could be missed
only if hashing put all shingles of a set into D of its slices (under 1e-7 for the smallest sets that use
slices, at the edge of their class; far less for others) and its differences fell into all of them, or if
two hashes collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import discard, stash
from caseload.llm.graph import components

GROWTH = 2.0  # of the size classes
SPARE = 1.4  # slices for each difference that may spoil one
PAIR_CLASS = 12  # classes with at most so many differences use pairs of shingles
SENT_ROWS = 1_000_000  # rows of 16 bytes that are sent to every task; beyond, a shuffle join
CACHED_WORDS = 250_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: ASCII lower case, words between ASCII white space."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * _A + h[i:len(h) - width + 1 + i]
    return np.unique(mix(out))


class Classes:
    """Size classes for similarity num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts, self.slices = [1], []
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(np.ceil(self.starts[-1] * GROWTH))))
        for end in self.starts[1:]:
            most = self.spoiled(((end - 1) * den) // num)
            self.slices.append(0 if most <= PAIR_CLASS else int(np.ceil(most * SPARE)) + 2)

    def spoiled(self, n: int) -> int:
        """Most shingles in which a set of ``n`` differs from one that it links to."""
        return n * (self.den - self.num) // self.num

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    def regions(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the regions that a set enters, in its own class and in those it is replicated to."""
        n = len(shingles)
        bad = self.spoiled(n)
        if not bad:
            return np.zeros(0, np.uint64)  # links to equal sets only
        out = []
        for c in range(self.of(-(-n * self.num // self.den)), self.of(n) + 1):
            seed = mix(np.array([c + 1], np.uint64) * _A)[0]
            own = mix(shingles ^ seed)
            if not self.slices[c]:
                first = np.sort(own)[:bad + 2]  # the first two common shingles of a pair are among these
                i, j = np.triu_indices(len(first), 1)
                out.append(mix(first[i] * _A + first[j]))
                continue
            slice_of = (own >> np.uint64(11)) % np.uint64(self.slices[c])
            order = np.argsort(slice_of, kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(slice_of[order]) > 0])
            sizes = np.diff(np.r_[at, n])
            keys = mix(np.add.reduceat(mix(own[order] + _C), at) + mix(slice_of[order][at] + seed))
            out.append(keys[np.lexsort((keys, -sizes))[:bad + 1]])
        return np.concatenate(out)


def sketches(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """id, code (hash of the text), n, sid (hash of the set, null for empty sets), keys of ``docs`` (id, text). A task
    gives the keys of equal sets once (as long as it remembers them)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes, classes, seen = WordHashes(), Classes(num, den), set()
        for batch in batches:
            n, sid, keys = [], [], []
            for text in batch["text"]:
                s = shingle_set(text, words, hashes)
                n.append(len(s))
                sid.append(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).astype(np.int64)[0] if len(s) else None)
                keys.append(np.zeros(0, np.int64) if sid[-1] in seen else classes.regions(s).astype(np.int64))
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen.add(sid[-1])
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "code": batch["code"], "n": n, "sid": pd.array(sid, "Int64"), "keys": keys})

    source = docs.select("id", F.xxhash64("text").alias("code"), "text")
    return source.mapInPandas(run, "id long, code long, n long, sid long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """sid, shingles of the texts that ``wanted`` (sid, id, code) names."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            yield pd.DataFrame({"sid": batch["sid"], "shingles": [shingle_set(t, words, hashes).astype(np.int64) for t in batch["text"]]})

    few = wanted.count() <= SENT_ROWS
    w = wanted.select("sid", F.col("id").alias("w_id"), F.col("code").alias("w_code"))
    texts = docs.withColumn("code", F.xxhash64("text")).join(
        F.broadcast(w) if few else w, (F.col("code") == F.col("w_code")) & F.col("id").eqNullSafe(F.col("w_id")))
    return stash(texts.select("sid", "text").mapInPandas(run, "sid long, shingles array<long>").dropDuplicates(["sid"]), "jaccard-sets")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common, total (sizes of intersection and union) of distinct ``pairs`` (a, b)."""
    left = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("sb"))
    right = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("sa"))
    both = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb") - common).alias("total"))


def _relabel(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (sid, label) after merging the components that ``edges`` (a, b) join."""
    a = labels.select(F.col("sid").alias("a"), F.col("label").alias("u"))
    b = labels.select(F.col("sid").alias("b"), F.col("label").alias("v"))
    roots = components(edges.join(a, "a").join(b, "b").select("u", "v"), "jaccard-components")
    merged = labels.join(roots.select(F.col("v").alias("label"), "root"), "label", "left")
    return stash(merged.select("sid", F.coalesce("root", "label").alias("label")), "jaccard-labels")


def _differences(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """p, sid, n, n_p, m, change: for distinct ``cells`` (p, sid), sizes of set and pivot, and the differences of the two."""
    own = sets.select(F.col("sid").alias("s"), F.col("shingles").alias("ss"))  # renamed as the pivots are: one exchange serves both
    pivot = sets.select(F.col("sid").alias("p"), F.col("shingles").alias("sp"))
    both = cells.withColumnRenamed("sid", "s").join(own, "s").join(pivot, "p").withColumnRenamed("s", "sid")
    change = F.concat(F.array_except("ss", "sp"), F.array_except("sp", "ss"))
    return both.select("p", "sid", F.size("ss").cast("long").alias("n"), F.size("sp").cast("long").alias("n_p"), change.alias("change")).withColumn("m", F.size("change").cast("long"))


def _cell_pairs(cells: DataFrame, changes: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that may link inside Voronoi cells: with the set nearest to linking anything, and all others.

    ``cells``: p, sid, n, m, label, inner (the set is in its pivot's component); ``changes``: p, sid, change. Symmetric difference
    is translation invariant: with x' the difference of x and p, |x ^ y| = |x'| + |y'| - 2 |x' & y'|. So x and y
    link if and only if e(x) + e(y) <= 2 (den + num) |x' & y'|, where e(x) = (den + num) |x'| - (den - num) |x|. If
    e(x) + e(y) <= 0 no common difference is needed; then x links to the cell's set of least e as well, and that
    pair is tried first. Otherwise x' and y' share differences, and by the prefix rule one of them is among the
    first |x'| - o + 1 of x (o: least overlap over all partners), rarest in the cell first. Windows by the
    triangle inequality, ||x'| - |y'|| <= |x ^ y|, bound the partners of each set.

    Of the differences that a pair shares, the first in that order comes with all others behind it: there,
    and so in one row at least, |x' & y'| is at most what is left of the shorter rest. Sets whose rest is too
    short for every other one that has the difference go before the join, pairs in the join."""
    e = F.expr(f"{den + num} * m - {den - num} * n")
    rows = cells.withColumn("e", e)
    nearest = rows.groupBy("p").agg(F.min(F.struct("e", "sid", "label")).alias("near"))
    rows = rows.join(nearest, "p")
    first = rows.where((F.col("label") != F.col("near.label")) & (F.col("e") + F.col("near.e") <= 0)).select("sid", F.col("near.sid").alias("other"))

    # a set that surely links to the nearest one (which is then an inner one) is an inner one as well
    rows = rows.withColumn("inner", F.col("inner") | (F.col("e") + F.col("near.e") <= 0))
    least = rows.groupBy("p").agg(F.min(F.when(~F.col("inner"), F.col("e"))).alias("least_out"), F.min(F.when(F.col("inner"), F.col("e"))).alias("least_in"))
    rows = rows.join(least.where(F.col("least_out").isNotNull()), "p")
    length = lambda other: F.greatest(F.lit(0), F.least(F.col("m"), F.col("m") + 1 - F.greatest(
        F.lit(1), F.ceil((F.col("e") + F.col(other)) / (2.0 * (den + num)) - 1e-9))))
    # outer sets meet outer and inner ones, inner sets meet outer ones alone
    rows = rows.withColumn("to_out", length("least_out")).withColumn("to_in", F.when(F.col("inner") | F.col("least_in").isNull(), 0).otherwise(length("least_in")))
    rows = stash(rows.where(F.greatest("to_out", "to_in") > 0).select("p", "sid", "n", "m", "e", "label", "inner", "to_out", "to_in"), "jaccard-prefixes")
    # one exchange of (p, g, sid) serves both: how many sets have a difference, and the rows of those that several have
    each = changes.join(rows.select("p", "sid"), ["p", "sid"]).select("p", "sid", F.explode("change").alias("g")).repartition("p", "g")
    held = each.groupBy("p", "g").agg(F.count("sid").alias("held")).where("held > 1")
    # differences that no other set of the cell has come first, and need no row: their number is where the others begin.
    # Of the others, the number of sets and 47 bits of the hash are the order, and stand for the difference from here on
    place = F.shiftleft(F.least("held", F.lit(0xFFFF).cast("long")), 47).bitwiseOR(F.col("g").bitwiseAND((1 << 47) - 1))
    order = each.join(held.hint("merge"), ["p", "g"]).groupBy("p", "sid").agg(F.sort_array(F.collect_list(place)).alias("order"))
    ahead = rows.join(order, ["p", "sid"]).withColumn("alone", F.col("m") - F.size("order")).withColumn(
        "order", F.slice("order", 1, F.greatest(F.lit(0), F.greatest("to_out", "to_in") - F.col("alone")).cast("int")))
    every = stash(ahead.select("p", "sid", "n", "m", "e", "label", "inner", "to_out", "to_in", "alone", F.posexplode("order").alias("nth", "g")).select(
        "p", "g", "sid", "n", "m", "e", "label", "inner", "to_out", "to_in", (F.col("alone") + F.col("nth")).alias("at")), "jaccard-every")
    del each, held, order, ahead
    # an outer set needs another one, an inner set an outer one
    having = every.groupBy("p", "g").agg(F.min("e").alias("any_e"), F.min(F.when(~F.col("inner"), F.col("e"))).alias("out_e"), F.count("*").alias("having"))
    rest = F.expr(f"{2 * (den + num)} * (m - at) >= e + if(inner, out_e, any_e)")
    entry = stash(every.join(having.where("having > 1 and out_e is not null"), ["p", "g"]).where(rest).drop("any_e", "out_e", "having"), "jaccard-entries")
    discard(every)
    one = entry.where(~F.col("inner")).select("p", "g", *[F.col(c).alias(c + "1") for c in ("sid", "n", "m", "e", "label", "to_out", "to_in", "at")])
    two = entry.select("p", "g", *[F.col(c).alias(c + "2") for c in ("sid", "n", "m", "e", "label", "inner", "to_out", "at")])
    window = F.expr(f"{den + num} * abs(m1 - m2) <= {den - num} * (n1 + n2)") & F.expr(f"{2 * (den + num)} * least(m1 - at1, m2 - at2) >= e1 + e2")
    reach = (F.col("at2") < F.col("to_out2")) & F.when(F.col("inner2"), F.col("at1") < F.col("to_in1")).otherwise(
        (F.col("at1") < F.col("to_out1")) & (F.col("sid1") < F.col("sid2")))
    found = one.join(two, ["p", "g"]).where((F.col("label1") != F.col("label2")) & window & reach)
    return first.select(*pair_of("sid", "other")).distinct(), found.select(*pair_of("sid1", "sid2")).distinct()


def pair_of(x: str, y: str) -> tuple:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def link_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(id, code, n, sid of every row of ``docs`` (id, text); sid, label of every set that may link to another)."""
    keyed = stash(sketches(docs, words, num, den), "jaccard-sketches")
    table = stash(keyed.select("id", "code", "n", "sid"), "jaccard-rows")
    # one exchange of (key, sid) serves both: which keys two sets have, and the rows of these
    entered = keyed.select("sid", F.explode("keys").alias("key")).where(F.col("key").isNotNull()).repartition("key")
    shared = entered.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low != high").select("key")
    both = stash(entered.join(shared.hint("merge"), "key").select("key", "sid"), "jaccard-shared")
    del entered, shared
    discard(keyed)
    both_once = both.distinct()
    sizes = both_once.groupBy("key").agg(F.count("*").alias("size"))
    members = stash(both_once.join(sizes, "key").select("key", "sid", "size"), "jaccard-regions")
    discard(both)

    degrees = stash(members.groupBy("sid").agg(F.sum(F.col("size") - 1).alias("degree")), "jaccard-degrees")
    named = table.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min(F.struct("id", "code")).alias("rep"))
    sets = _sets(docs, named.join(degrees.select("sid"), "sid", "left_semi").select("sid", "rep.id", "rep.code"), words)
    labels = degrees.select("sid", F.col("sid").alias("label"))

    def linked(x: DataFrame) -> DataFrame:
        return x.where(den * F.col("common") >= num * F.col("total")).select("a", "b")

    # stars: each set against the pivot it shares most regions with
    ranked = members.select("key", "sid").join(degrees, "sid")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("degree", "sid")).alias("top")).select("key", F.col("top.sid").alias("a"), F.col("top.degree").alias("rank"))
    met = members.join(pivots, "key").where(F.col("sid") != F.col("a")).groupBy("sid", "a").agg(F.count("*").alias("n"), F.max("rank").alias("rank"))
    best = met.groupBy("sid").agg(F.max(F.struct("n", "rank", "a")).alias("top")).select(F.col("top.a").alias("a"), F.col("sid").alias("b"))
    tested = stash(_compare(best, sets), "jaccard-tested")
    labels = _relabel(labels, linked(tested))

    # cells: the sets of the regions that still hold several components, around their regions' pivots
    for nth in range(2):  # labels after the links to pivots, then the pairs inside cells
        named = members.select("key", "sid").join(labels, "sid")
        still = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
        cells = stash(named.join(still, "key").join(pivots.select("key", F.col("a").alias("p")), "key").where("sid != p").select(
            "p", "sid", "label").distinct(), "jaccard-cells")
        if nth:
            break
        discard()
        # the differences from the pivots tell which sets link to them, and serve the pairs inside cells
        changes = stash(_differences(cells.select("p", "sid"), sets), "jaccard-changes")
        to_pivot = changes.where(F.expr(f"{den + num} * m <= {den - num} * (n + n_p)"))
        labels = _relabel(labels, to_pivot.select(F.col("p").alias("a"), F.col("sid").alias("b")))
        discard(cells)
    own = labels.select(F.col("sid").alias("p"), F.col("label").alias("p_label"))
    inside = cells.join(own, "p").withColumn("inner", F.col("label") == F.col("p_label")).drop("p_label")
    slim = stash(changes.select("p", "sid", "n", "m").join(inside, ["p", "sid"]), "jaccard-members")
    discard(degrees)  # and the shuffle files of the steps so far
    near, rest = _cell_pairs(slim, changes.select("p", "sid", "change"), num, den)
    pairs = stash(near.unionByName(rest).distinct(), "jaccard-pairs")
    del near, rest
    discard(changes, slim)
    named = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    labels = _relabel(labels, linked(_compare(pairs, sets.join(named, "sid", "left_semi"))))
    discard(members, sets, tested, cells, pairs)
    return table, labels


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))


def _component_ids(rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """id, code, n, component_id of every row (id, text)."""
    table, labels = link_components(rows, words, num, den)
    firsts = table.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("id").alias("first")).join(labels, "sid", "left")
    firsts = stash(firsts.withColumn("label", F.coalesce("label", "sid")), "jaccard-firsts")
    least = firsts.groupBy("label").agg(F.min("first").alias("component_id"))
    out = table.join(firsts.join(least, "label").select("sid", "component_id"), "sid", "left")
    return out.select("id", "code", "n", F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id of every row of ``docs``.

    Sets of ``words``-word shingles (fewer words: the whole sequence as one) link when their Jaccard
    similarity is at least num / den; equal sets always link. component_id is the smallest id reachable
    by links. Rows without words (null and empty texts) link with nothing and are their own component.
    Repeated rows are returned each; null ids are never a component's id unless it has no other; an empty
    table gives no rows; other columns are ignored."""
    out = _component_ids(_rows(docs, id_col, text_col), words, num, den)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose id is that of their component: one document of each group.

    Rows that repeat an id and a text are one document and stay or go together; so are rows without an
    id and with one text. Rows without words all stay."""
    rows = _rows(docs, id_col, text_col)
    gone = _component_ids(rows, words, num, den).where(~F.col("id").eqNullSafe(F.col("component_id"))).select(
        F.col("id").alias("gone_id"), F.col("code").alias("gone_code")).distinct()
    gone = stash(gone, "jaccard-gone")
    gone = F.broadcast(gone) if gone.count() <= SENT_ROWS else gone
    code = F.xxhash64(F.col(f"`{text_col}`"))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("gone_id")) & code.eqNullSafe(F.col("gone_code"))
    return docs.join(gone, same, "left_anti")
