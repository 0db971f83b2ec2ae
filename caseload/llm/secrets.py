"""Secret scanning with an incremental blob ledger, DataFrame functions only.

Every version of a text is a blob, named by the SHA-256 of its UTF-8 bytes. The ledger holds one row
per (blob, rule, rule version) that has been scanned, with the spans found. A scan takes only the
(blob, rule, version) triples that the ledger lacks; findings are joined back to every path that
holds the blob. Copies are scanned once, and a new rule version rescans with that rule alone.

Spans are code points, end exclusive, of the whole match. ``split`` and ``regexp_extract_all`` walk
the same leftmost non-overlapping matches, so the lengths of pieces and matches give the positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import stash, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``group``'s length in the match must reach ``least``; ``version`` names this wording of the rule."""

    kind: str
    pattern: str
    group: int
    least: int
    version: str = "1"


# fixed values of the contract: kinds in listed order, their patterns and least lengths
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # a run that [0-9a-f]+ takes whole; shorter runs fail anyway
)

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, version string, spans {SPANS}"


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start,end>> of the rule's matches whose group is long enough."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m) >= rule.least)
    walk = F.arrays_zip(gaps.alias("gap"), lengths.alias("n"), kept.alias("kept"))  # the last gap has no match
    empty = F.array().cast(SPANS)
    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["n"], F.lit(0))
        found = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["kept"], F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(rule.pattern), F.aggregate(walk, zero, step, lambda acc: acc["out"])).otherwise(empty)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: one per (blob, rule, version) of ``versions`` (blob, text) that ``ledger`` lacks.

    Equal blobs are first reduced to one text (before and after the shuffle), so a blob held by a
    third of all paths is scanned once."""
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        known = [F.col("rule") == r.kind for r in rules]
        seen = ledger.groupBy("blob").agg(*[
            F.max(F.when(k & (F.col("version") == r.version), F.lit(True))).alias(f"seen_{r.kind}") for r, k in zip(rules, known)])
        blobs = blobs.join(seen, "blob", "left")
    else:
        blobs = blobs.select("*", *[F.lit(None).cast("boolean").alias(f"seen_{r.kind}") for r in rules])
    rows = F.array(*[F.when(F.col(f"seen_{r.kind}").isNull(), F.struct(
        F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans_of(F.col("text"), r).alias("spans"))) for r in rules])
    return blobs.select("blob", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select(
        "blob", "x.rule", "x.version", "x.spans")


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` (any columns and blob) with one array<struct<start,end>> column per rule, from the ledger.

    Only blobs with findings are joined, so the table on the right is small against the paths; a blob
    of very many paths is a hot key of a left join, which Spark splits."""
    current = None
    for r in rules:
        hit = (F.col("rule") == r.kind) & (F.col("version") == r.version)
        current = hit if current is None else current | hit
    found = ledger.where(current & (F.size("spans") > 0)).groupBy("blob").agg(
        *[F.max(F.when(F.col("rule") == r.kind, F.col("spans"))).alias(f"spans_{r.kind}") for r in rules])
    empty = F.array().cast(SPANS)
    out = paths.join(found, "blob", "left")
    return out.select(*paths.columns, *[F.coalesce(f"spans_{r.kind}", empty).alias(f"spans_{r.kind}") for r in rules])


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings per row of ``docs``, ledger after the scan).

    Null texts are scanned as empty, null and repeated ids are paths like any other, an empty table
    gives no rows, other columns of ``docs`` are ignored. The new ledger rows are written to the
    shared folder before they are joined."""
    blob = F.sha2(F.col("text").cast("binary"), 256)
    versions = docs.select(F.col(f"`{id_col}`").alias("path"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    fresh = stash(scan_unseen(versions.select(blob.alias("blob"), "text"), ledger, rules), "secret-ledger")
    after = fresh if ledger is None else ledger.select(*fresh.columns).unionByName(fresh)
    paths = versions.select(F.col("path").alias(id_col), blob.alias("blob"))
    return findings(paths, after, rules), after


def span_text(rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a findings row as kind:start:end by start, then kind as listed, comma-joined."""
    def said(nth: int, kind: str):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(nth).alias("nth"),
                                  F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("said"))

    each = [F.transform(f"spans_{r.kind}", said(i, r.kind)) for i, r in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*each)), lambda x: x["said"]), ",")
