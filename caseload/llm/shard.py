"""Sharding by minimax contiguous partition, DataFrame functions only.

Rows with equal texts form an atomic group. Groups are put in one order, and the order is cut into
``shards`` contiguous runs so that the largest run (in bytes) is as small as possible: a binary
search finds the smallest capacity for which greedy filling needs at most ``shards`` runs, and the
cuts are those of the greedy filling at that capacity.

Neither the groups nor their sizes travel to the driver. The greedy check runs on block sums
(``2**BLOCK_BITS`` blocks of the key space). A block counts once as divisible at will (capacity
that is surely needed) and once as indivisible (capacity that surely suffices). Blocks in which a
cut may fall are split into 64 and summed again until both searches meet, so the capacity found is
the exact optimum over all groups. Each round moves a bounded number of block sums.

Order: by a 63-bit hash of the text, so any block holds a like share. Heavy groups (more than
1/``HEAVY`` of all bytes or rows; at most ``2 * HEAVY`` exist) are first spread over the shards,
largest first onto the least loaded, and stand in the order where their shard's run begins; else a
large group in a bad place would leave the run before it short. Groups whose 63-bit hashes are
equal travel together. A group as large as the mean of what is left has a shard to itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseload.llm.common import inline, stash, text_or_empty

KEY_BITS = 63
BLOCK_BITS = 12
SPLIT_BITS = 6
HEAVY = 1024
ROWS_PER_SLOT_BLOCK = 20_000


@dataclass
class Element:
    """A block of the key space (``key`` in units of ``2**width``) or, if ``heavy`` >= 0, one heavy group."""

    key: int
    width: int
    size: int
    atom: bool
    heavy: int = -1


def needed(sizes: list[int], atoms: list[bool], capacity: int, limit: int) -> tuple[int, list[tuple[int, int]]]:
    """Greedy filling: how many runs are needed (``limit + 1`` if more than that, or if an atom does not
    fit), and for each cut the element and the bytes of it before the cut."""
    runs, free, cuts = 1, capacity, []
    for i, (size, atom) in enumerate(zip(sizes, atoms)):
        if size <= free:
            free -= size
            continue
        if atom:
            if size > capacity:
                return limit + 1, cuts + [(i, 0)]
            runs, free = runs + 1, capacity - size
            cuts.append((i, 0))
        else:
            left, used = size - free, free
            while left > 0:
                cuts.append((i, used))
                runs, take = runs + 1, min(left, capacity)
                used, left, free = used + take, left - take, capacity - take
                if runs > limit:
                    break
        if runs > limit:
            return limit + 1, cuts
    return runs, cuts


def smallest_capacity(sizes: list[int], atoms: list[bool], shards: int) -> int:
    """Binary search for the least capacity at which the greedy filling needs at most ``shards`` runs."""
    total = sum(sizes)
    low = max([-(-total // shards), *(s for s, a in zip(sizes, atoms) if a)])
    high = max(low, total)
    while low < high:
        mid = (low + high) // 2
        if needed(sizes, atoms, mid, shards)[0] <= shards:
            high = mid
        else:
            low = mid + 1
    return low


def _spread(heavies: list[tuple], light: int, shards: int, blocks: int) -> tuple[list[list[int]], list[int]]:
    """Heavy groups by shard (largest first onto the least loaded), and where each shard's light blocks begin."""
    load, placed = [0] * shards, [[] for _ in range(shards)]
    for i, (_, size, _) in enumerate(heavies):
        s = min(range(shards), key=lambda k: (load[k], k))
        load[s] += size
        placed[s].append(i)
    order = sorted(load)
    level, below = 0.0, 0
    for k in range(1, shards + 1):  # water level at which the light bytes fill the shards evenly
        below += order[k - 1]
        level = (light + below) / k
        if k == shards or level <= order[k]:
            break
    room = [max(0.0, level - x) for x in load]
    starts, run, whole = [], 0.0, sum(room) or 1.0
    for r in room:
        starts.append(round(run / whole * blocks))
        run += r
    return placed, starts


def _block_sums(groups: DataFrame, wanted: list[Element], heavy_keys: list[int]) -> dict[tuple[int, int], tuple[int, int]]:
    """(width, block) -> (bytes, groups), of all blocks (``wanted`` empty) or of the parts of wanted blocks."""
    light = groups if not heavy_keys else groups.join(
        F.broadcast(inline(groups.sparkSession, [(k,) for k in heavy_keys], "key bigint")), "key", "left_anti")
    if not wanted:
        parts = [(KEY_BITS - BLOCK_BITS, None)]
    else:
        parts = [(w, [e.key for e in wanted if e.width == w]) for w in sorted({e.width for e in wanted})]
    width, keep = F.lit(None).cast("int"), F.lit(False)
    for w, keys in parts:
        inside = F.lit(True) if keys is None else F.shiftright("key", w).isin(keys)
        width = F.when(inside, F.lit(w if keys is None else max(0, w - SPLIT_BITS))).otherwise(width)
        keep = keep | inside
    part = light.where(keep).select(width.alias("width"), "key", "bytes")
    part = part.select("width", F.expr("shiftright(key, width)").alias("block"), "bytes")
    rows = part.groupBy("width", "block").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    return {(r.width, r.block): (r.bytes, r.n) for r in rows}


def plan_cuts(groups: DataFrame, heavies: list[tuple], light: int, shards: int, left_out: list[tuple] = ()) -> tuple[int, list[int], dict[int, int]]:
    """Smallest capacity, the ``shards - 1`` cut keys of the light groups, and the shard of each heavy group.

    ``groups``: key, bytes. ``heavies``: (key, bytes, rows). ``light``: bytes of all other groups.
    ``left_out``: groups that have shards of their own."""
    blocks = 1 << BLOCK_BITS
    placed, starts = _spread(heavies, light, shards, blocks)
    heavy_keys = [h[0] for h in [*heavies, *left_out]]
    width = KEY_BITS - BLOCK_BITS
    sums = _block_sums(groups, [], heavy_keys)
    elements: list[Element] = []
    for s in range(shards):
        elements += [Element(0, 0, heavies[i][1], True, i) for i in placed[s]]
        end = starts[s + 1] if s + 1 < shards else blocks
        elements += [Element(b, width, sums[width, b][0], sums[width, b][1] == 1)
                     for b in range(starts[s], end) if (width, b) in sums]
    while True:
        sizes, fluid, solid = [e.size for e in elements], [e.atom for e in elements], [True] * len(elements)
        low, high = smallest_capacity(sizes, fluid, shards), smallest_capacity(sizes, solid, shards)
        if low == high:
            break
        early, late = needed(sizes, solid, low, shards)[1], needed(sizes, fluid, high, shards)[1]
        n = len(elements)
        early += [early[-1] if early else (0, 0)] * shards
        wanted: set[int] = set()
        for j in range(shards - 1):
            first, last = early[j][0], late[j][0] if j < len(late) else n - 1
            wanted.update(i for i in range(max(0, first - 1), min(n, last + 1)) if not elements[i].atom)
        if not wanted:
            break
        sums = _block_sums(groups, [elements[i] for i in sorted(wanted)], heavy_keys)
        finer: list[Element] = []
        for i, e in enumerate(elements):
            if i not in wanted:
                finer.append(e)
                continue
            w = max(0, e.width - SPLIT_BITS)
            first = e.key << (e.width - w)
            finer += [Element(b, w, sums[w, b][0], sums[w, b][1] == 1 or w == 0)
                      for b in range(first, first + (1 << (e.width - w))) if (w, b) in sums]
        elements = finer
    cut_at = sorted(i for i, _ in needed(sizes, solid, high, shards)[1])
    shard_of, keys, shard = {}, [], 0
    cut_left = iter([*cut_at, None])
    nxt = next(cut_left)
    for i, e in enumerate(elements):
        while nxt == i:
            shard, nxt = shard + 1, next(cut_left)
        if e.heavy >= 0:
            shard_of[e.heavy] = shard
        else:
            while len(keys) < shard:
                keys.append(e.key << e.width)
    return high, keys, shard_of


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row of ``docs`` to a shard and a gapless slot in it.

    Returns ``id_col``, size (UTF-8 bytes + 1), text_crc32, shard, slot. Null texts have no bytes
    and stand in one group with empty texts; null and repeated ids are rows like any other; equal
    texts always share a shard; an empty table gives no rows; other columns are ignored.
    Groups are never split, so a shard may be as large as a group that is larger than the mean.
    """
    spark = docs.sparkSession
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = stash(docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = stash(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    all_bytes, n = total.bytes or 0, total.n or 0
    heavies = [tuple(r) for r in groups.where((F.col("bytes") > all_bytes // HEAVY) | (F.col("n") > n // HEAVY + 1))
               .orderBy(F.desc("bytes"), "key").select("key", "bytes", "n").collect()]
    alone, rest = 0, all_bytes  # groups of at least the mean of what is left have a shard each, at the end of the order
    while shards - alone > 1 and alone < len(heavies) and heavies[alone][1] * (shards - alone) >= rest:
        rest -= heavies[alone][1]
        alone += 1
    _, cuts, placed = plan_cuts(groups, heavies[alone:], all_bytes - sum(h[1] for h in heavies), shards - alone, heavies[:alone])
    shard_of = {i: shards - alone + i for i in range(alone)} | {alone + i: s for i, s in placed.items()}

    # slots: rows per block of a shard, offsets over the (bounded) blocks, row numbers inside a block
    bits = max(6, min(16, (n // ROWS_PER_SLOT_BLOCK).bit_length() + 4))
    table = inline(spark, [(k, i, shard_of[i], max(1, -(-c // ROWS_PER_SLOT_BLOCK))) for i, (k, _, c) in enumerate(heavies)],
                   "key bigint,heavy int,heavy_shard int,salts int")
    light = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("key"))) if cuts else F.lit(0)
    at = rows.join(F.broadcast(table), "key", "left").select(
        "id", "size", "text_crc32", "key", "row", F.coalesce("heavy_shard", light).cast("int").alias("shard"),
        F.coalesce("heavy", F.lit(-1)).alias("part"),
        F.when(F.col("heavy").isNotNull(), F.pmod(F.xxhash64("row"), F.col("salts").cast("long")))
        .otherwise(F.shiftright("key", KEY_BITS - bits)).alias("block"))
    counts = at.groupBy("shard", "part", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part", "block").orderBy("key", "id", "row")
    return at.withColumn("nth", F.row_number().over(inside)).join(offsets, ["shard", "part", "block"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("offset") + F.col("nth") - 1).alias("slot"))
