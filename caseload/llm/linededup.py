"""Exact removal of repeated lines behind two Bloom filters.

Pass 1 streams every long line key through a pair of bit arrays per task: ``once`` (a key set this
bit) and ``twice`` (a second key found it set). The pairs are merged chunk by chunk in rounds of
``FAN_IN`` tasks; a bit that two tasks have set once becomes a ``twice`` bit. A key in two documents
has all its bits in ``twice``, so nothing is missed. Pass 2 sends only keys found in ``twice`` to the
shuffle, where the documents of each are counted exactly and the surviving one is chosen.

The filters have between ``MIN_BITS`` and ``MAX_BITS`` bits (32 MB), chosen from the number of text
bytes; beyond that more lines are suspected, and the result stays the same. The confirmed keys are
sent to every task while they are at most ``SENT_KEYS``; beyond that the documents are joined with
their keys instead.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseload.llm.common import SPACES, small_batches, stash

MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
BYTES_PER_BIT = 32  # text bytes; a line of 160 bytes sets two bits of five
CHUNK = 1 << 16  # bytes of a filter that one merge task takes
FAN_IN = 64
SENT_KEYS = 250_000  # 24 bytes each


def line_key(line: str, least: int) -> bytes | None:
    """Digest of the line's key, None if the key has fewer than ``least`` code points."""
    key = line.strip(SPACES)
    if len(key) < least:
        return None
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()  # bytes.lower: A-Z only


def _long_keys(text: str | None, least: int) -> set[bytes]:
    return {k for line in text.split("\n") if len(line) >= least and (k := line_key(line, least))} if text else set()


def _places(keys: list[bytes], bits: int) -> np.ndarray:
    """Two bit places for each key."""
    return (np.frombuffer(b"".join(keys), "<u8") % np.uint64(bits)).astype(np.int64)


def _pass1(bits: int, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        held: list[bytes] = []

        def add() -> None:
            if held:
                place, n = np.unique(_places(held, bits), return_counts=True)
                byte, bit = place >> 3, (1 << (place & 7)).astype(np.uint8)
                again = (n > 1) | ((once[byte] & bit) > 0)
                np.bitwise_or.at(twice, byte[again], bit[again])
                np.bitwise_or.at(once, byte, bit)
                held.clear()

        for batch in batches:
            for text in batch["text"]:
                held.extend(_long_keys(text, least))
                if len(held) > 30_000:
                    add()
        add()
        part = TaskContext.get().partitionId()
        for start in range(0, bits // 8, CHUNK):
            if once[start:start + CHUNK].any():
                yield _row(part, start, once[start:start + CHUNK], twice[start:start + CHUNK])

    return run


def _row(part: int, chunk: int, once: np.ndarray, twice: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"part": [part], "chunk": [chunk], "once": [zlib.compress(once.tobytes(), 1)],
                         "twice": [zlib.compress(twice.tobytes(), 1)]})


def _merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for o, t in zip(frame["once"], frame["twice"]):
        o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
        once, twice = (o, t) if once is None else (once | o, twice | t | (once & o))
    return _row(key[1], key[0], once, twice)


def repeat_filter(docs: DataFrame, bits: int, least: int) -> np.ndarray:
    """The merged ``twice`` filter of column text: ``bits`` bits, a bounded array."""
    schema = "part long, chunk long, once binary, twice binary"
    parts = docs.select("text").mapInPandas(_pass1(bits, least), schema)
    tasks = docs.select("text").rdd.getNumPartitions()
    while True:
        tasks = -(-tasks // FAN_IN)
        parts = parts.groupBy("chunk", F.floor(F.col("part") / FAN_IN).alias("part")).applyInPandas(_merge, schema)
        if tasks <= 1:
            break
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.select("chunk", "twice").toLocalIterator():
        data = np.frombuffer(zlib.decompress(row.twice), np.uint8)
        out[row.chunk:row.chunk + len(data)] = data
    return out


def suspects(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """id, key: of each document (id, text), the long line keys that may stand in a second one."""
    sent = docs.sparkSession.sparkContext.broadcast(repeat_filter(docs, bits, least).tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        twice = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch["id"], batch["text"]):
                if found := list(_long_keys(text, least)):
                    ids.extend([doc] * len(found))
                    keys.extend(found)
            if keys:
                place = _places(keys, bits)
                hit = ((twice[place >> 3] >> (place & 7).astype(np.uint8)) & 1).reshape(-1, 2).all(axis=1)
                yield pd.DataFrame({"id": pd.array(ids, "Int64")[hit], "key": np.array(keys, object)[hit]})

    return docs.select("id", "text").mapInPandas(run, "id long, key binary")


def _cut(text: str | None, least: int, loses) -> tuple[str | None, int, int]:
    """(text without the lines whose key ``loses`` names, lines before, lines dropped)."""
    if not text:
        return text, 1, 0
    lines = text.split("\n")
    kept = [x for x in lines if len(x) < least or (k := line_key(x, least)) is None or not loses(k)]
    return ("\n".join(kept), len(lines), len(lines) - len(kept)) if len(kept) < len(lines) else (text, len(lines), 0)


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, sent_keys: int = SENT_KEYS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop repeated lines from ``docs``; returns all its columns and n_lines, n_dropped (long).

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least
    ``least_chars`` code points found in at least ``least_docs`` documents lose all their lines except
    in the largest id that holds them. Null and empty texts are one empty line and stay as they are; a
    text that loses all lines becomes empty. A document is its id: rows that repeat an id count once
    and are treated alike; rows without an id count as one document, smaller than all others. An empty
    table gives no rows. Columns of ``docs`` named n_lines or n_dropped are replaced.
    """
    small_batches(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (size // BYTES_PER_BIT).bit_length()))
    held = stash(suspects(base, bits, least_chars), "line-suspects").distinct()
    # held has one row per (key, document), so a line of every document is counted in many tasks
    exact = held.groupBy("key").agg(F.count("*").alias("docs"), F.max("id").alias("keeper"))
    losing = stash(exact.where(F.col("docs") >= least_docs).select("key", "keeper"), "line-losing")

    fields = [f for f in docs.select(*own).schema.fields]
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in fields]
    if losing.count() <= sent_keys:
        keepers = {bytes(r.key): r.keeper for r in losing.collect()}
        sent = docs.sparkSession.sparkContext.broadcast(keepers)
        source = docs.select(*own, F.col(f"`{id_col}`").cast("long").alias("__given"))  # given: the row's id

        def loses(given):
            table = sent.value
            return lambda k: k in table and table[k] != given
    else:
        drops = held.join(losing, "key").where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id").agg(
            F.collect_set("key").alias("__given")).withColumnRenamed("id", "__doc")  # given: the keys it loses
        source = docs.select(*own).join(drops, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__doc")), "left").drop("__doc")

        def loses(given):
            lost = {bytes(k) for k in given or ()}
            return lambda k: k in lost

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            given, texts = batch.column(len(names)).to_pylist(), batch.column(names.index(text_col)).to_pylist()
            done = [_cut(t, least_chars, loses(g)) for t, g in zip(texts, given)]
            cols = [batch.column(i) for i in range(len(names))]
            cols[names.index(text_col)] = pa.array([d[0] for d in done], pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                                             [*names, "n_lines", "n_dropped"])

    return source.mapInArrow(run, schema)
