"""Packing of tokenized documents into sequences: best-fit decreasing with certified bounds.

Texts become token ids followed by one end id. Only documents longer than a sequence are cut; pieces as
long as a sequence are sequences of their own. All other pieces are dealt evenly over partitions, and
each partition is packed best-fit decreasing. Dual feasible functions of its lengths give a lower bound
on the bins it needs; a partition whose bin count equals the bound is certified. Partitions with a gap
give the pieces of their unfilled bins to an exchange, together with every partition's unfilled bins
that rounding up may have cost; the exchange is dealt anew, to partitions of twice the size, and packed
again, for as long as the bins become fewer and the bound over all lengths is not met.

Only (id, piece, start, length, checksum) rows travel, never token ids, and a partition holds about
``PART_ROWS`` rows of them, at most ``2 ** (ROUNDS - 1)`` times that in an exchange, whatever the input.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import stash

CAPACITY = 2048
END_ID = 0
PART_ROWS = 20_000
ROUNDS = 4
CACHED_WORDS = 400_000
GROUP_CHARS = 1_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Latin letters in UTF-8 (after ASCII lower-casing) and signs after them: the tokenizer splits between the two,
#: and neither part depends on the other. Apostrophes are left out: with letters they make tokens of their own.
_LETTERS = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_PLAIN = re.compile(rb"(" + _LETTERS + rb")([!-&(-/:-@\[-`{-~]*)")


#: A stop or comma that ends a chunk after a Latin letter is a chunk of its own: far fewer chunks are distinct. The sign
#: stands first in the expression, so that only signs are looked at, not every byte.
_STOP = re.compile(rb"([.,])(?:(?<=[a-z].)|(?<=\xc3[\xa0-\xb6\xb8-\xbf].))(?=[ \n]|\Z)")


class WordIds(dict):
    """Token ids (packed little-endian) of chunks without white space; bounded, filled by the tokenizer.

    The tokenizer lower-cases and drops white space, and no token spans it, so chunks are independent.
    New plain words are encoded together in one text and told apart by the tokens that end a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def add_words(self, words: list[bytes]) -> None:
        """Words of letters alone: one token that ends a word for each."""
        if not words:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode("utf-8")], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words):
            raw, stops = ids.tobytes(), (4 * stops).tolist()
            self.update(zip(words, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops))))
        else:
            self.update((w, self.encode(w.decode("utf-8"))) for w in words)

    def add(self, chunks: set[bytes]) -> None:
        if len(self) + len(chunks) > CACHED_WORDS:
            self.clear()
        words, parts, rest, plain = set(), [], set(), _PLAIN.fullmatch
        for chunk in chunks:
            if chunk.isalpha():
                words.add(chunk)
            elif m := plain(chunk):
                words.add(m[1])
                if m[2]:
                    parts.append((chunk, m[1], m[2]))
                    rest.add(m[2])
            else:
                rest.add(chunk)
        self.add_words(list(words - self.keys()))
        self.update((x, self.encode(x.decode("utf-8"))) for x in rest - self.keys())
        self.update((chunk, self[word] + self[signs]) for chunk, word, signs in parts)

    def texts(self, texts: list[str | None]) -> Iterator[bytes]:
        """The packed ids of each text, computed in groups of about ``GROUP_CHARS``."""
        group, size = [], 0
        for text in texts:
            raw = (text or "").encode("utf-8")
            if b"<|" not in raw:  # special tokens are matched before lower-casing
                raw = raw.lower()
            group.append(_STOP.sub(rb" \1", raw).split())
            size += len(raw)
            if size > GROUP_CHARS:
                yield from self._join(group)
                group, size = [], 0
        yield from self._join(group)

    def _join(self, group: list[list[bytes]]) -> Iterator[bytes]:
        got = [list(map(self.get, chunks)) for chunks in group]
        lacking = [k for k, ids in enumerate(got) if None in ids]
        if lacking:
            self.add(set(chain.from_iterable(compress(group[k], map(is_, got[k], repeat(None))) for k in lacking)))
            for k in lacking:
                ids, chunks, at = got[k], group[k], -1
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    ids[at] = self[chunks[at]]
        yield from map(b"".join, got)


def tokenized(docs: DataFrame, path: str, capacity: int, with_ids: bool) -> DataFrame:
    """One row per piece of every document (columns of ``PIECES``, and ids if wanted)."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordIds(path)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["id"], words.texts(list(batch["text"]))):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start:4 * (start + capacity)]
                    rows.append((doc, piece, start, len(part) // 4, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype("int32")] if with_ids else ())))
            frame = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.mapInPandas(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every length, longest first into the fullest bin that takes it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0  # bit r: some bin has room r
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            by_room[room - size].append(b)
            open_rooms |= 1 << (room - size)
    return bins, offsets


def lower_bound(counts: np.ndarray) -> int:
    """Least number of bins for ``counts[length]`` pieces (index 0 to capacity), by dual feasible functions:
    the identity, rounding to k+1 parts, and thresholds that drop small pieces and round large ones up."""
    capacity = len(counts) - 1
    x = np.arange(capacity + 1)
    best = -(-int((counts * x).sum()) // capacity)
    for k in range(1, 33):
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity)
        u = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * u).sum()) // (k * capacity)))
    number, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * x)])
    e = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - e + 1]
    middle = total[capacity - e + 1] - total[e]
    return max(best, int((large + -(-middle // capacity)).max(initial=0)))


def _pack(capacity: int, turn: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1))
        fill = np.bincount(bins, weights=lengths)
        return frame.drop(columns="part").assign(offset=offsets, sequence_id=((turn << 24) + int(key[0]) << 32) + bins,
                            unfilled=fill[bins] < capacity, gap=int(bins.max()) + 1 - bound)

    return run


PACKED = PIECES + ", salt long, offset long, sequence_id long, unfilled boolean, gap long"


def _packed(pieces: DataFrame, capacity: int, turn: int, part_rows: int) -> DataFrame:
    parts = max(1, -(-pieces.count() // part_rows))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("salt", F.lit(turn)), F.lit(parts).cast("long")))
    return stash(dealt.groupBy("part").applyInPandas(_pack(capacity, turn), PACKED), "packed")


def pack_pieces(pieces: DataFrame, capacity: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``PIECES`` columns with sequence_id and offset; ``pieces`` (columns of ``PIECES``, salt) are shorter than a sequence."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[row["length"]] = row["count"]
    if not counts.any():
        return pieces.select(*PIECES_NAMES, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bound = lower_bound(counts)
    done, now = [], _packed(pieces, capacity, 0, part_rows)
    used = now.select("sequence_id").distinct().count()
    for turn in range(1, ROUNDS):
        if used <= bound:
            break
        # unfilled bins: of partitions with a gap, and what each partition lost by rounding up
        loose = now.where("unfilled")
        before = loose.select("sequence_id").distinct().count()
        again = _packed(loose.select(*PIECES_NAMES, "salt"), capacity, turn, part_rows << turn)
        after = again.select("sequence_id").distinct().count()
        if after >= before:
            break
        done.append(now.where(~F.col("unfilled")))
        used, now = used - before + after, again
    out = now
    for x in done:
        out = out.unionByName(x)
    return out.select(*PIECES_NAMES, "sequence_id", "offset")


PIECES_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         part_rows: int = PART_ROWS) -> DataFrame:
    """Pack every row of ``docs``: one row per piece, the columns of ``PIECES``, sequence_id and offset.

    Null and empty texts are the end id alone. Null and repeated ids are documents like any other, equal
    rows are packed each, an empty table gives no rows, other columns are ignored. A very long text is
    cut into full sequences and one last piece. The tokenizer file is read where the tasks run."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    pieces = tokenized(source, tokenizer_path, capacity, False)
    rows = stash(pieces.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    full = rows.where(F.col("length") == capacity).select(
        *PIECES_NAMES, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(pack_pieces(rows.where(F.col("length") < capacity), capacity, part_rows))


def sequences(docs: DataFrame, packed: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, ids: the token ids of each packed sequence (ids of ``docs`` must be distinct)."""
    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    ids = tokenized(source, tokenizer_path, capacity, True).select("doc_id", "piece", "ids")
    placed = packed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    ordered = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"))
    return ordered.select("sequence_id", F.flatten(F.transform("x", lambda p: p["ids"])).alias("ids"))
