"""Byte spans that occur twice, by a distributed merge sort of front-coded suffix runs.

A position x of a text is an *anchor* where the 8 bytes at x hash lowest among a window of ``length // 2``
consecutive positions. The anchor of a string is fixed by its own bytes, so two copies of a string hold the
same anchor at the same place, and every start p has one anchor, ``anchor(p)``, less than half a length after it.
1. Texts that are equal as a whole are reduced to one; a 64-bit hash of the bytes after an anchor (as many as
   any repeated string has left there) finds the anchors whose context occurs again. The rest can't be matched.
2. Each task sorts the suffixes at its remaining anchors (cut at 3/2 lengths) and front-codes the run: bytes shared
   with the entry before, then the rest. Runs are cut at sampled splitters and exchanged; a loser tree merges
   them, carrying the known common prefix of each head with the last output, and compares bytes only after it.
   An entry's longest match is the larger of its common prefixes with its two neighbours.
3. With e(x), the end of the longest match from x: start p is repeated if an anchor before it has e >= p + length,
   and is not if e(anchor(p)) < p + length. What lies between, a window's width where a match begins, is
   settled by hashes (64 bits of the anchor's context and 64 of the string) of all strings of these contexts.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import discard, rereadable, small_batches, stash

GRAM = 8
#: Bytes of text that are hashed at once; a task holds some 140 bytes for each of them.
PIECE_BYTES = 1 << 18
#: Bytes of suffixes that a task sorts to one run; it holds some 3.3 bytes for each of them.
RUN_BYTES = 32 << 20
#: Bytes of suffixes that one task merges, about.
MERGE_BYTES = 24 << 20
#: Sampled suffixes for each merging task.
SAMPLES = 24
#: Rows, spans or anchors of a table that is sent to all tasks (a few MB); beyond it, a shuffle join.
SENT_ROWS = 100_000

_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out, done = np.ones(n, np.uint64), 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


class Hasher:
    """Anchors and hashes of the strings of a buffer."""

    def __init__(self, length: int):
        self.length, self.width = length, length // 2
        self.gram = min(GRAM, self.width)
        self.context, self.cap = length - self.width + 1, length + self.width
        self.up = self.down = np.ones(0, np.uint64)

    def load(self, data: bytes) -> None:
        n = len(data)
        if len(self.up) < n:
            size = max(n, PIECE_BYTES)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        v = np.ndarray((n,), "<u8", data + bytes(8), 0, (1,)).astype(np.uint64)  # the 8 bytes at every place
        if self.gram < 8:
            v = v & np.uint64((1 << 8 * self.gram) - 1)
        v = (v + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0x9E3779B97F4A7C15)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(32)
        self.mixed = v
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * self.up[:n], dtype=np.uint64)])

    def strings(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes that begin ``at`` these places."""
        out = (self.sums[at + (size - self.gram + 1)] - self.sums[at]) * self.down[at]
        return (out ^ (out >> np.uint64(31))).view(np.int64)

    def anchors(self, starts: np.ndarray) -> np.ndarray:
        """The anchor of each start; the buffer goes on for at least ``length`` bytes after it."""
        n, w = len(self.mixed), self.width
        blocks = -(-(n + w) // w)
        order = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
        order[:n] = (self.mixed & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        order = order.reshape(blocks, w)
        ahead = np.minimum.accumulate(order, axis=1).ravel()
        behind = np.minimum.accumulate(order[:, ::-1], axis=1)[:, ::-1].ravel()
        return (np.minimum(behind[starts], ahead[starts + (w - 1)]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _pieces(rows, length: int):
    """Lists of (row, offset, bytes) of about ``PIECE_BYTES``; a long text is cut, each piece with the bytes that
    its last starts need."""
    held, size = [], 0
    for row, text in rows:
        for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
            piece = text[at:at + PIECE_BYTES + length - 1]
            if len(piece) < length:
                continue
            held.append((row, at, piece))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _anchor_rows(rows, length: int):
    """(row, anchor, first start, last start, hash of the context) arrays of texts of at least ``length`` bytes."""
    tool, held = Hasher(length), None  # held: the last anchor, which may go on in the next piece
    for pieces in _pieces(rows, length):
        sizes = np.array([len(p[2]) for p in pieces])
        begin = np.cumsum(sizes) - sizes
        tool.load(b"".join(p[2] for p in pieces))
        counts = sizes - length + 1
        which = np.repeat(np.arange(len(pieces)), counts)
        starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begin[which]
        found = tool.anchors(starts)
        row, shift = np.array([p[0] for p in pieces], np.int64)[which], (np.array([p[1] for p in pieces]) - begin)[which]
        place = found + shift
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
        last = np.append(first[1:], len(found)) - 1
        out = [row[first], place[first], (starts + shift)[first], (starts + shift)[last], tool.strings(found[first], tool.context)]
        if held is not None:
            if held[0][0] == out[0][0] and held[1][0] == out[1][0]:
                out[2][0] = held[2][0]
            else:
                yield held
        held = [c[-1:].copy() for c in out]
        yield [c[:-1] for c in out]
    if held is not None:
        yield held


def anchor_table(texts: DataFrame, length: int) -> DataFrame:
    """row, at, low, high, context: the anchors of each text (row, data) and the starts that have them."""
    def run(batches):
        import pyarrow as pa

        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        for cols in _anchor_rows(rows(), length):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "at", "low", "high", "context"])

    return texts.select("row", "data").mapInArrow(run, "row long, at long, low long, high long, context long")


# ---------------------------------------------------------------------------------- front-coded runs
def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known; only bytes after these are compared."""
    n, step, at = min(len(a), len(b)), 16, known
    while at < n and a[at:at + step] == b[at:at + step]:
        at += step
        step *= 2
    if at >= n:
        return n
    high = min(n, at + step)
    while high - at > 1:
        mid = (at + high) // 2
        if a[at:mid] == b[at:mid]:
            at = mid
        else:
            high = mid
    return at + (a[at:at + 1] == b[at:at + 1])


def merge_runs(runs: list) -> list[tuple[int, bytes, object]]:
    """Merge sorted runs of (bytes shared with the entry before, string, payload) by a loser tree.

    Returns the entries in order with the length of each one's common prefix with the entry before it. Each
    head keeps the length of its common prefix with the last output; where two differ, the longer is the
    smaller string and nothing is compared; where they agree, comparison begins behind it.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    sources = [iter(r) for r in runs] + [iter(())] * (size - len(runs))
    heads, shared, load = [None] * size, [0] * size, [None] * size

    def advance(r: int) -> None:
        shared[r], heads[r], load[r] = next(sources[r], (-1, None, None))

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes that with the winner."""
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        if heads[a] is None:
            return a, b
        x, y = heads[a], heads[b]
        n = common_prefix(x, y, shared[a])
        if x[n:n + 1] <= y[n:n + 1]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    for r in range(size):
        advance(r)
    losers, level = [0] * size, list(range(size))
    while len(level) > 1:
        base, level = len(level) // 2, [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        for i, (_, lost) in enumerate(level):
            losers[base + i] = lost
        level = [won for won, _ in level]
    best, out = level[0], []
    while heads[best] is not None:
        out.append((shared[best], heads[best], load[best]))
        advance(best)
        node = (size + best) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2
    return out


def front_code(entries: list) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared lengths, lengths of the rests, rests) of sorted (string, ...) entries."""
    shared, rests, before = [], [], b""
    for entry in entries:
        n = common_prefix(before, entry[0])
        shared.append(n)
        rests.append(entry[0][n:])
        before = entry[0]
    return np.array(shared, np.int32), np.array([len(r) for r in rests], np.int32), b"".join(rests)


def front_decode(shared: np.ndarray, sizes: np.ndarray, rests: bytes):
    """(shared length, string) of each entry."""
    before, at = b"", 0
    for n, size in zip(shared.tolist(), sizes.tolist()):
        before = before[:n] + rests[at:at + size]
        at += size
        yield n, before


def _run_rows(entries: list, splitters: list[bytes]):
    """One sorted run cut at the splitters. Each part also gets the run's last entry before it and first entry
    behind it, without members, so that its first and last strings meet their true neighbours."""
    entries.sort()
    merged: list[list] = []
    for string, row, at in entries:
        if merged and merged[-1][0] == string:
            merged[-1][1].append((row, at))
        else:
            merged.append([string, [(row, at)]])
    strings = [m[0] for m in merged]
    cuts = [0, *[bisect_left(strings, s) for s in splitters], len(strings)]
    run = uuid.uuid4().hex
    for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
        own = [[m[0], []] for m in merged[max(0, low - 1):low]] + merged[low:high] + [[m[0], []] for m in merged[high:high + 1]]
        shared, sizes, rests = front_code(own)
        members = np.array([x for m in own for x in m[1]], np.int64).reshape(-1, 2)
        yield (part, run, shared.tobytes(), sizes.tobytes(), rests, np.array([len(m[1]) for m in own], np.int32).tobytes(), members.tobytes())


_RUN = "part int, run string, shared binary, sizes binary, rests binary, counts binary, members binary"


def _suffixes(batches, cap: int):
    for batch in batches:
        for row, data, places in zip(batch["row"], batch["data"], batch["places"]):
            for at in places:
                yield data[at:at + cap], row, int(at)


def suffix_runs(texts: DataFrame, cap: int, splitters: list[bytes]) -> DataFrame:
    """Sorted front-coded runs of the suffixes of texts (row, data, places), cut at the splitters."""
    def run(batches):
        held, size, columns = [], 0, [c.split()[0] for c in _RUN.split(", ")]
        for entry in _suffixes(batches, cap):
            held.append(entry)
            size += len(entry[0])
            if size >= RUN_BYTES:
                yield pd.DataFrame(_run_rows(held, splitters), columns=columns)
                held, size = [], 0
        if held:
            yield pd.DataFrame(_run_rows(held, splitters), columns=columns)

    return texts.select("row", "data", "places").mapInPandas(run, _RUN)


def _merge_part(part: pd.DataFrame) -> pd.DataFrame:
    def entries(row):
        members = np.frombuffer(row.members, np.int64).reshape(-1, 2)
        ends = np.cumsum(np.frombuffer(row.counts, np.int32))
        start = 0
        for (n, string), end in zip(front_decode(np.frombuffer(row.shared, np.int32), np.frombuffer(row.sizes, np.int32), row.rests), ends.tolist()):
            yield n, string, members[start:end]
            start = end

    out = merge_runs([entries(row) for row in part.sort_values("run").itertuples()])
    after = [*[x[0] for x in out[1:]], 0]
    rows, match = [], []
    for (n, string, members), behind in zip(out, after):
        if len(members):
            rows.append(members)
            match.append(np.full(len(members), len(string) if len(members) > 1 else max(n, behind), np.int64))
    if not rows:
        return pd.DataFrame({"row": np.zeros(0, np.int64), "at": np.zeros(0, np.int64), "match": np.zeros(0, np.int64)})
    rows = np.concatenate(rows)
    return pd.DataFrame({"row": rows[:, 0], "at": rows[:, 1], "match": np.concatenate(match)})


def longest_matches(texts: DataFrame, cap: int, places: int) -> DataFrame:
    """row, at, match: for each place of texts (row, data, places), the most bytes (up to ``cap``) that the suffix there
    shares with the suffix at any other place of the table. ``places``: their number."""
    parts = max(1, -(-places * cap // MERGE_BYTES))
    every = max(1, places // (parts * SAMPLES))

    def sample(batches):
        for batch in batches:
            out = [s for s, row, at in _suffixes([batch], cap) if (row * 0x9E3779B1 + at * 0x85EBCA6B >> 7) % every == 0]
            yield pd.DataFrame({"s": out})

    splitters: list[bytes] = []
    if parts > 1:  # a fixed number of samples for each merging task
        drawn = sorted({bytes(r.s) for r in texts.select("row", "data", "places").mapInPandas(sample, "s binary").toLocalIterator()})
        splitters = sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}) if drawn else []
    return suffix_runs(texts, cap, splitters).groupBy("part").applyInPandas(_merge_part, "row long, at long, match long")


# ---------------------------------------------------------------------------------- repeated starts
def _joined(left: DataFrame, right: DataFrame, key: str, how: str, rows: int) -> DataFrame:
    return left.join(F.broadcast(right) if rows <= SENT_ROWS else right, key, how)


def _settle(batch: pd.DataFrame, length: int) -> tuple[list, list]:
    """(spans, open anchors) of texts with anchor arrays: spans that certainly repeat, and anchors with starts that
    a match may or may not reach."""
    spans, unsure = [], []
    for row, anchors in zip(batch["row"], batch["anchors"]):
        got = np.array([(a["at"], a["low"], a["high"], a["context"], a["match"]) for a in anchors], np.int64).reshape(-1, 5)
        got = got[np.argsort(got[:, 0], kind="stable")]
        at, low, high, context, end = got[:, 0], got[:, 1], got[:, 2], got[:, 3], got[:, 0] + got[:, 4]
        top = np.minimum(high, end - length)
        reach = np.maximum.accumulate(end)
        counts = np.maximum(0, top - low + 1)
        which = np.repeat(np.arange(len(at)), counts)
        starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        before = np.searchsorted(at, starts, "right") - 1
        sure = (before >= 0) & (reach[np.maximum(before, 0)] >= starts + length)
        spans.extend((row, int(a), int(b)) for a, b in _covered(starts[sure], length))
        left, own = starts[~sure], which[~sure]
        if len(left):
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            last = np.append(first[1:], len(own)) - 1
            unsure.extend(zip([row] * len(first), at[own[first]].tolist(), context[own[first]].tolist(), left[first].tolist(), left[last].tolist()))
    return spans, unsure


def _covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The bytes of strings at these starts, as maximal [begin, end)."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist()))


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """row, start, stop: spans that cover every byte of a string of ``length`` bytes that also begins at any other place
    of texts (row, data). Spans may overlap. ``texts`` must give the same rows whenever it is read."""
    tool = Hasher(length)
    anchors = stash(anchor_table(texts, length), "suffix-anchors")
    # written first: its join then has plain exchanges on both sides, and a context of very many anchors is split
    again = stash(anchors.groupBy("context").agg(F.count("*").alias("n")).where("n > 1").select("context"), "suffix-again")
    kept = stash(anchors.join(again, "context").groupBy("row").agg(F.collect_list(F.struct("at", "low", "high", "context")).alias("anchors")), "suffix-kept")
    discard(anchors, again)  # here and below: tables that were read for the last time, and the shuffle files of their steps
    places = kept.agg(F.sum(F.size("anchors"))).first()[0] or 0
    held = stash(_joined(texts, kept, "row", "inner", places)
                 .select("row", "data", F.transform("anchors", lambda a: a["at"]).alias("places")), "suffix-texts")
    matches = longest_matches(held, tool.cap, places)
    flat = kept.select("row", F.explode("anchors").alias("a")).select("row", "a.*")
    scored = flat.join(matches.where(F.col("match") >= tool.context), ["row", "at"])
    byrow = stash(scored.groupBy("row").agg(F.collect_list(F.struct("at", "low", "high", "context", "match")).alias("anchors")), "suffix-matches")
    discard(kept)

    def settle(batches):
        for batch in batches:
            spans, unsure = _settle(batch, length)
            rows = [(r, a, b, None, None, None) for r, a, b in spans] + [(r, low, high, at, c, 1) for r, at, c, low, high in unsure]
            names = ("row", "start", "stop", "at", "context", "open")
            yield pd.DataFrame({n: pd.array([r[i] for r in rows], "Int64") for i, n in enumerate(names)})  # by column: hashes stay exact

    settled = stash(byrow.mapInPandas(settle, "row long, start long, stop long, at long, context long, open long"), "suffix-settled")
    unsure = settled.where("open = 1")
    # of a context with unsure starts, all strings at the same distances before the anchor
    asked = unsure.groupBy("context").agg(F.min(F.col("at") - F.col("stop")).alias("near"), F.max(F.col("at") - F.col("start")).alias("far"))
    ours = unsure.select("row", "at", F.col("start").alias("ask_low"), F.col("stop").alias("ask_high"))
    members = byrow.select("row", F.explode("anchors").alias("a")).select("row", "a.*").join(asked, "context")
    members = members.select("row", "at", "context", F.greatest(F.col("low"), F.col("at") - F.col("far")).alias("low"),
                             F.least(F.col("high"), F.col("at") - F.col("near"), F.col("at") + F.col("match") - length).alias("high"))
    members = members.where("low <= high").join(ours, ["row", "at"], "left")
    wanted = stash(members.groupBy("row").agg(F.collect_list(F.struct("context", "low", "high", "ask_low", "ask_high")).alias("asked")), "suffix-asked")
    discard(byrow)

    def probe(batches):
        import pyarrow as pa

        tool = Hasher(length)
        for batch in batches:
            for row, data, asks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for at in range(0, len(data), PIECE_BYTES):
                    own = [(a["context"], max(a["low"], at), min(a["high"], at + PIECE_BYTES - 1), a["ask_low"], a["ask_high"]) for a in asks]
                    own = [a for a in own if a[1] <= a[2]]
                    if not own:
                        continue
                    counts = np.array([a[2] - a[1] + 1 for a in own])
                    starts = np.concatenate([np.arange(a[1], a[2] + 1) for a in own])
                    tool.load(data[at:at + PIECE_BYTES + length])
                    ask = np.concatenate([(np.arange(a[1], a[2] + 1) >= a[3]) & (np.arange(a[1], a[2] + 1) <= a[4]) if a[3] is not None
                                          else np.zeros(a[2] - a[1] + 1, bool) for a in own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.array([a[0] for a in own], np.int64), counts)), pa.array(tool.strings(starts - at, length)),
                         pa.array(np.full(len(starts), row, np.int64)), pa.array(starts.astype(np.int64)), pa.array(ask)], ["context", "string", "row", "start", "ask"])

    n = wanted.agg(F.coalesce(F.sum(1 + F.size("asked")), F.lit(0))).first()[0]
    strings = stash(_joined(held.select("row", "data"), wanted, "row", "inner", n).mapInArrow(
        probe, "context long, string long, row long, start long, ask boolean"), "suffix-strings")
    discard(held, wanted)
    twice = strings.groupBy("context", "string").agg(F.count("*").alias("n"), F.max("ask").alias("ask")).where("n > 1 and ask")
    twice = stash(twice.select("context", "string"), "suffix-twice")
    discard()
    hits = strings.where("ask").join(twice, ["context", "string"]).select("row", "start", (F.col("start") + length).alias("stop"))
    out = stash(settled.where("open is null").select("row", "start", "stop").unionByName(hits), "suffix-spans")
    discard(settled, strings, twice)
    return out


_SPANS = "array<struct<start:bigint,stop:bigint>>"


def _joined_spans(batches):
    """Overlapping and adjoining spans of each row become one."""
    for batch in batches:
        done = []
        for spans in batch["spans"]:
            got = np.array([(s["start"], s["stop"]) for s in spans], np.int64)
            got = got[np.argsort(got[:, 0], kind="stable")]
            reach = np.maximum.accumulate(got[:, 1])
            first = np.flatnonzero(np.concatenate([[True], got[1:, 0] > reach[:-1]]))
            done.append([{"start": a, "stop": b} for a, b in zip(got[first, 0].tolist(), reach[np.append(first[1:], len(got)) - 1].tolist())])
        yield pd.DataFrame({"row": batch["row"], "removed": done})


def dedup_spans(docs: DataFrame, length: int = 400, text_col: str = "text") -> DataFrame:
    """Remove repeated spans; returns the columns of ``docs`` and ``removed`` (array of [start, stop) in bytes, maximal
    and in order) and ``kept`` (binary, the bytes left).

    Texts are their UTF-8 bytes, a null text is empty. A byte goes if a string of ``length`` (at least 2) bytes covers
    it that also begins anywhere else, in the same text or another; strings never cross texts and are judged on
    the input. Copies of a text of at least ``length`` bytes therefore go whole, repeated rows included; shorter
    texts stay. An empty table gives no rows. Columns of ``docs`` named removed or kept are replaced.
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    small_batches(docs.sparkSession)
    own = [c for c in docs.columns if c not in ("removed", "kept")]
    base = rereadable(docs.select([F.col(f"`{c}`") for c in own]), "suffix-docs")
    given = base.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("given"), F.monotonically_increasing_id().alias("row"))
    data = F.coalesce(F.col(f"given.`{text_col}`"), F.lit("")).cast("binary").alias("data")
    numbered = given.select("row", data)
    ids = numbered.where(F.length("data") >= length).select("row", F.unhex(F.md5("data")).alias("same"))
    ids = stash(ids, "suffix-ids")
    firsts = ids.groupBy("same").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = stash(ids.join(firsts, "same").select("row", (F.col("row") != F.col("first")).alias("later")), "suffix-copies")
    n_copies = copies.count()
    texts = _joined(numbered.where(F.length("data") >= length).select("row", "data"), copies.where("later").select("row"), "row", "left_anti", n_copies)
    spans = repeated_spans(texts, length)
    empty = F.array().cast(_SPANS)
    byrow = stash(spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).mapInPandas(_joined_spans, f"row long, removed {_SPANS}")
                  .unionByName(copies.select("row", F.lit(None).cast(_SPANS).alias("removed"))), "suffix-removed")
    byrow = byrow.groupBy("row").agg(F.max(F.col("removed").isNull()).alias("whole"), F.max("removed").alias("removed"))
    n_rows = byrow.agg(F.coalesce(F.sum(1 + F.coalesce(F.size("removed"), F.lit(0))), F.lit(0))).first()[0]
    done = _joined(given, byrow, "row", "left", n_rows).select("*", data)  # the text goes once, its bytes are made after the join
    size = F.length("data").cast("long")
    done = done.withColumn("removed", F.when(F.col("whole"), F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("stop"))))
                           .otherwise(F.coalesce("removed", empty)))
    cuts = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"))), F.col("removed"),
                    F.array(F.struct(size.alias("start"), size.alias("stop"))))
    cuts = F.zip_with(F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts) - 1), lambda a, b: F.struct(a["stop"].alias("start"), b["start"].alias("stop")))
    rest = F.unhex(F.array_join(F.transform(cuts, lambda c: F.hex(F.substring(F.col("data"), (c["start"] + 1).cast("int"), (c["stop"] - c["start"]).cast("int")))), ""))
    kept = F.when(F.size("removed") == 0, F.col("data")).otherwise(rest)
    return done.select("given.*", "removed", kept.alias("kept"))
