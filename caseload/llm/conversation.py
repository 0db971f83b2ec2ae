"""Conversation repair: the cheapest edits that make the roles alternate, by bidirectional Dijkstra.

The edit lattice of a conversation has a node for each (rows read, state); states are: begun, after a system
row, after a user row, after an assistant row. Edges keep, rerole or delete the next row, or insert an empty row.
In every state only one role of user and assistant fits, so an audit (the edits' initials) fixes the repair.

Rows are range-partitioned and sorted by conversation and turn; a task reads them once, in blocks of at most
``BLOCK`` rows. A conversation inside one block is solved there. Of a longer one, or one at a task's edge, each block
gives the cheapest audit between every two states; these few rows are put together from the last block to the first,
and its rows are read once more, as a stream, for the repaired turns. Nothing holds more than a block of texts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import namedtuple
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import SPACES, discard, small_batches, stash

BLOCK = 512
BEGUN, SYSTEM, USER, ASSISTANT = range(4)
STATES, GOALS = (BEGUN, SYSTEM, USER, ASSISTANT), (BEGUN, ASSISTANT)
#: The state after a row whose role begins with this letter; a role without letters changes nothing.
STEP = {(BEGUN, "s"): SYSTEM, (BEGUN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER} | {(s, ""): s for s in STATES}
#: The role that an inserted or reroled row has in a state.
FITS = {BEGUN: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
BLANK, DUPLICATE, CUT = 1, 2, 3  # faults of a row; 0: none


# ---------------------------------------------------------------------------------- the lattice
def _ahead(rows, i: int, s: int):
    """(cost, label, i, s) edges out of a node. rows: (role's initial, fault)."""
    if i < len(rows):
        initial, fault = rows[i]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED * (fault == CUT)
            if (s, initial) in STEP:
                yield more, "K", i + 1, STEP[s, initial]
            yield REROLE + more, "R", i + 1, STEP[s, FITS[s][0]]
        yield DELETE, "D", i + 1, s
    yield INSERT, "I", i, STEP[s, FITS[s][0]]


def _behind(rows, i: int, s: int):
    """(cost, label, i, s) edges into a node."""
    for before in STATES:
        for at in (i - 1, i):
            if at >= 0:
                for cost, label, j, t in _ahead(rows, at, before):
                    if (j, t) == (i, s):
                        yield cost, label, at, before


def cheapest(rows: list, source: int, goals: tuple) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way from state ``source`` before the rows to one of ``goals`` after them, the
    least audit among equals; None if there is none.

    Forward labels leave the heap by (cost, audit): an edge only lengthens an audit, and of two audits to one node at
    one cost neither begins the other, so the least stays least. Reverse labels leave by (cost, rows left): edges without
    cost read a row. The searches stop once their least costs add up to more than the best crossing, so that
    every crossing of that cost is found; the least concatenated audit wins.
    """
    n = len(rows)
    done, back = {}, {(n, g): (0, "") for g in goals}
    ahead, behind, best = [(0, "", 0, source)], [], float("inf")

    def push_back(i, s, cost, audit):
        for c, label, j, t in _behind(rows, i, s):
            heapq.heappush(behind, (cost + c, -j, label + audit, t))

    for g in goals:
        push_back(n, g, 0, "")
    while ahead or behind:
        if (ahead[0][0] if ahead else best) + (behind[0][0] if behind else best) > best:
            break
        if ahead and (not behind or ahead[0][0] < behind[0][0]):
            cost, audit, i, s = heapq.heappop(ahead)
            if (i, s) in done:
                continue
            done[i, s] = cost, audit
            if (i, s) in back:
                best = min(best, cost + back[i, s][0])
            for c, label, j, t in _ahead(rows, i, s):
                if (j, t) in back:
                    best = min(best, cost + c + back[j, t][0])
                if (j, t) not in done:
                    heapq.heappush(ahead, (cost + c, audit + label, j, t))
        else:
            cost, at, audit, s = heapq.heappop(behind)
            if (-at, s) in back:
                continue
            back[-at, s] = cost, audit
            if (-at, s) in done:
                best = min(best, cost + done[-at, s][0])
            for c, _, j, t in _behind(rows, -at, s):
                if (j, t) in done:
                    best = min(best, done[j, t][0] + c + cost)
            push_back(-at, s, cost, audit)
    found = [audit + back[node][1] for node, (cost, audit) in done.items() if node in back and cost + back[node][0] == best]
    for (i, s), (cost, audit) in done.items():
        found += [audit + label + back[j, t][1] for c, label, j, t in _ahead(rows, i, s) if (j, t) in back and cost + c + back[j, t][0] == best]
    return (best, min(found)) if found else None


def apply_audit(rows, audit: str, state: int):
    """(edit, role, text) of each turn kept or made, and the state behind; rows: (role, text)."""
    out, rows = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        role = role if edit == "K" else FITS[state]
        state = STEP[state, role[:1]]
        out.append((edit, role, text))
    return out, state


# ---------------------------------------------------------------------------------- faults
def with_faults(damaged: DataFrame) -> DataFrame:
    """Runs of equal rows (conv_id, turn, role, text, copies) with ``faults``: blank, truncated, later (seen before)."""
    runs = damaged.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"), F.min("marker").alias("marker"))
    runs = stash(runs.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))), "conversation-runs")
    # the first turn of each (role, text); every key of the join is unique, so no conversation is one task's load
    firsts = runs.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("f"))
    firsts = firsts.select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), F.col("f.turn").alias("f_turn"))
    same = (F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("role").eqNullSafe(F.col("f_role"))
            & F.col("digest").eqNullSafe(F.col("f_digest")) & F.col("turn").eqNullSafe(F.col("f_turn")))
    bare = F.rtrim(F.translate("text", SPACES, " " * len(SPACES)))
    return runs.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
        (F.col("f_role").isNull()).alias("later"))


def _rows_of(run) -> list[tuple]:
    """(initial, fault, role, text, turn) of each copy of a run."""
    out = []
    for k in range(run.copies):
        fault = BLANK if run.blank else DUPLICATE if run.later or k else CUT if run.cut else 0
        out.append((run.role[:1], fault, run.role, run.text, run.turn))
    return out


_BLOCK = ("conv_id long, part int, seq int, alone boolean, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "low long, high long, turns long, first_turn long, last_turn long, costs array<long>, audits array<string>, "
          "repaired array<struct<edit:string,role:string,text:string>>")


def _block(conv, part: int, seq: int, alone: bool, rows: list) -> tuple:
    turns = [r[4] for r in rows if r[4] is not None]
    counts = [sum(r[1] == f for r in rows) for f in (BLANK, DUPLICATE, CUT)]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lattice = [r[:2] for r in rows]
    if alone:
        cost, audit = cheapest(lattice, BEGUN, GOALS)
        costs, audits, repaired = [cost], [audit], apply_audit([r[2:4] for r in rows], audit, BEGUN)[0]
    else:
        ways = [cheapest(lattice, s, (g,)) for s in STATES for g in STATES]
        costs, audits, repaired = [w[0] if w else None for w in ways], [w[1] if w else None for w in ways], None
    return (conv, part, seq, alone, len(rows), *counts, illegal, rows[0][0] if rows else None, rows[-1][0] if rows else None, min(turns, default=None),
            max(turns, default=None), len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None, costs, audits,
            None if repaired is None else [{"edit": e, "role": r, "text": t} for e, r, t in repaired])


def _batch(rows: list, names: list[str], kinds):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrow(schema: str) -> list:
    """Arrow types of a schema of longs, ints, booleans, strings and the lists used here."""
    import pyarrow as pa

    turns = pa.list_(pa.struct([(n, pa.string()) for n in ("edit", "role", "text")]))
    known = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string()), "array<struct<edit:string,role:string,text:string>>": turns}
    return [known[c.split()[1]] for c in schema.split(", ")]


def _runs(batches):
    """The rows of Arrow batches; null and large numbers stay as they are."""
    for batch in batches:
        kind = namedtuple("Run", batch.schema.names)
        yield from map(kind, *[c.to_pylist() for c in batch.columns])


def _blocks(batches):
    """Blocks of the conversations of one sorted partition."""
    from pyspark import TaskContext

    part, size = TaskContext.get().partitionId(), BLOCK
    out, waiting = [], None  # waiting: a block that may be its conversation's only one
    first = True
    for conv, runs in groupby(_runs(batches), lambda r: r.conv_id):
        if waiting is not None:
            out.append(_block(*waiting))
            waiting = None
        seq, rows, edge = 0, [], first
        first = False
        for run in runs:
            for row in _rows_of(run):
                if len(rows) == size:
                    out.append(_block(conv, part, seq, False, rows))
                    seq, rows = seq + 1, []
                rows.append(row)
        waiting = (conv, part, seq, seq == 0 and not edge, rows)
        if len(out) >= 500:
            yield _batch(out, _names(_BLOCK), _arrow(_BLOCK))
            out = []
    if waiting is not None:
        out.append(_block(*waiting[:3], False, waiting[4]))  # the conversation may go on in the next partition
    if out:
        yield _batch(out, _names(_BLOCK), _arrow(_BLOCK))


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _together(blocks: pd.DataFrame) -> pd.DataFrame:
    """One conversation's report from its blocks' counts and ways; no texts."""
    blocks = blocks.sort_values(["part", "seq"])
    best = {g: (0, "") for g in GOALS}
    for b in blocks[::-1].itertuples():
        ways = {(s, g): (int(c), a) for (s, g), c, a in zip([(s, g) for s in STATES for g in STATES], b.costs, b.audits) if a is not None}
        best = {s: min((ways[s, g][0] + best[g][0], ways[s, g][1] + best[g][1]) for g in STATES if (s, g) in ways and g in best) for s in STATES
                if any((s, g) in ways and g in best for g in STATES)}
    cost, audit = best[BEGUN]
    some = [b for b in blocks.itertuples() if b.n]
    illegal = sum(int(b.illegal) for b in some) + sum(a.last + b.first not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
    dated = [b for b in some if b.low is not None]
    distinct = sum(int(b.turns) for b in dated) - sum(a.last_turn == b.first_turn for a, b in zip(dated, dated[1:]))
    gaps = int(dated[-1].high) - int(dated[0].low) + 1 - distinct if dated else 0
    row = (blocks["conv_id"].iloc[0], gaps, *[int(blocks[c].sum()) for c in ("blank", "duplicate", "truncated")], illegal, cost, audit)
    return pd.DataFrame([row], columns=_names(_REPORT)).astype({"conv_id": "Int64"})


_PIECE = "conv_id long, piece long, repaired array<struct<edit:string,role:string,text:string>>"


def _pieces(batches):
    """Repaired turns of long conversations, a block at a time; each conversation's audit comes before its rows."""
    out, size = [], BLOCK
    for conv, runs in groupby(_runs(batches), lambda r: r.conv_id):
        audit, at, state, piece, rows = "", 0, BEGUN, 0, []

        def flush(last: bool):
            nonlocal at, state, piece
            end, left = at, len(rows)
            while left or end < len(audit) and (last or audit[end] == "I"):
                left -= audit[end] != "I"
                end += 1
            done, state = apply_audit([r[2:4] for r in rows], audit[at:end], state)
            out.append((conv, piece, [{"edit": e, "role": r, "text": t} for e, r, t in done]))
            at, piece = end, piece + 1
            rows.clear()

        for run in runs:
            if run.audit is not None:
                audit = run.audit
                continue
            for row in _rows_of(run):
                rows.append(row)
                if len(rows) == size:
                    flush(False)
                    yield _batch(out, _names(_PIECE), _arrow(_PIECE))
                    out = []
        flush(True)
    if out:
        yield _batch(out, _names(_PIECE), _arrow(_PIECE))


def repair(damaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations; returns (report, pieces).

    ``damaged`` has conv_id, turn (long), role, text (string, not null), copies (int: so many equal adjacent rows;
    0: the row is gone but its conversation is still reported), and any other columns, which are ignored. Rows are taken
    by turn (nulls first), then role, then text. report: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit; one row per conversation, null being one. pieces: conv_id, piece, repaired (turns kept or made, with edit, role,
    text); a long conversation has several, in order. A conversation without rows has zeros, an empty audit and no
    turns; an empty table gives no rows.
    """
    spark = damaged.sparkSession
    small_batches(spark)
    rows = damaged.select(
        F.col("conv_id").cast("long").alias("conv_id"), *[F.when(F.col("copies") > 0, F.col(c)).alias(c) for c in ("turn", "role", "text")],
        F.col("copies").cast("long").alias("copies"), F.lit(0).alias("marker"))
    faults = stash(with_faults(rows), "conversation-faults")
    order = ["conv_id", "turn", "role", "text"]
    blocks = stash(faults.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, _BLOCK), "conversation-blocks")
    alone = blocks.where("alone")
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    short = alone.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    # turns as text: pandas makes doubles of whole numbers with nulls
    several = blocks.where("not alone").select("conv_id", "part", "seq", "n", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns",
                                               *[F.col(c).cast("string").alias(c) for c in ("low", "high", "first_turn", "last_turn")], "costs", "audits")
    long = stash(several.groupBy("conv_id").applyInPandas(_together, _REPORT), "conversation-long")
    # conversations of several blocks or at a task's edge: their rows once more, after the audit
    keys = long.select(F.col("conv_id").alias("l_conv"), F.lit(True).alias("l"))
    again = faults.join(keys, F.col("conv_id").eqNullSafe(F.col("l_conv"))).select(*faults.columns, F.lit(None).cast("string").alias("audit"), F.lit(1).alias("kind"))
    heads = long.select("conv_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in faults.schema.fields[1:]], "audit", F.lit(0).alias("kind"))
    streamed = again.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").mapInArrow(_pieces, _PIECE)
    streamed = stash(streamed, "conversation-pieces")
    discard(faults)
    report = short.unionByName(long)
    pieces = alone.select("conv_id", F.lit(0).cast("long").alias("piece"), "repaired").unionByName(streamed)
    return report, pieces


def repaired_digest(report: DataFrame, pieces: DataFrame) -> DataFrame:
    """``report`` and repaired_sha256: lower-case hex SHA-256 of the repaired turns as role:text, joined by newlines."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    last = pieces.groupBy("conv_id").agg(F.max("piece").alias("last"))
    sized = pieces.join(last.select(F.col("conv_id").alias("p_conv"), "last"), F.col("conv_id").eqNullSafe(F.col("p_conv"))).drop("p_conv")
    one = sized.where("last = 0").select("conv_id", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"))
    many = sized.where("last > 0").select("conv_id", "piece", F.size("repaired").alias("n"), F.array_join(lines, "\n").alias("body"))

    def digest(batches):
        for conv, rows in groupby(_runs(batches), lambda r: r.conv_id):
            sha, begun = hashlib.sha256(), False
            for row in rows:
                if row.n:
                    sha.update((b"\n" if begun else b"") + row.body.encode())
                    begun = True
            yield _batch([(conv, sha.hexdigest())], ["conv_id", "repaired_sha256"], _arrow("conv_id long, repaired_sha256 string"))

    many = many.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(digest, "conv_id long, repaired_sha256 string")
    digests = one.unionByName(many).withColumnRenamed("conv_id", "d_conv")
    return report.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv"))).drop("d_conv")


def contract_damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of the contract's damage: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its
    text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's. A null is one space."""
    key: Column = F.concat(*[x if isinstance(x, Column) else F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", F.lit(":"), "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
