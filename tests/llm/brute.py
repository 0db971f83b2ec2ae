"""Plain Python truths for the training-data operators."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def secrets(text: str | None) -> dict:
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    n = Counter(k for _, k, _ in spans)
    return {"n_assign": n[0], "n_access": n[1], "n_hex": n[2], "base_sha256": hashlib.sha256(said.encode()).hexdigest(), "spans": said}


def line_dedup(docs: list[tuple], least_chars: int = 40, least_docs: int = 5) -> list[tuple]:
    """(doc_id, lines, dropped, kept text) of (doc_id, text) rows."""
    key = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least_chars:
                held[key(x)].add(i)
    order = lambda i: (i is not None, i or 0)
    lost = {k: max(v, key=order) for k, v in held.items() if len(v) >= least_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in lost or lost[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def statistics(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def warc(pages: list[tuple]) -> dict:
    """page_id -> (bytes, digest, type, refers_to) of (page_id, html) rows with distinct ids."""
    by = defaultdict(list)
    for p, h in pages:
        by[(h or "").encode()].append(p)
    out = {}
    for body, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for p in ids:
            out[p] = (len(body), digest, "response" if p == min(ids) else "revisit", None if p == min(ids) else min(ids))
    return out


def shingles(text: str | None, n: int = 3) -> set:
    w = words(lower(text or ""))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(docs: list[tuple], n: int = 3, num: int = 90, den: int = 100) -> dict:
    """doc_id -> (set size, smallest linked id) by an inverted index over all sets."""
    sets = {i: shingles(t, n) for i, t in docs}
    classes = defaultdict(list)
    for i, s in sets.items():
        classes[frozenset(s)].append(i)
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    reps = []
    for s, ids in classes.items():
        if s:
            ids = sorted(ids)
            reps.append((s, ids[0]))
            for i in ids[1:]:
                up[find(i)] = find(ids[0])
    index = defaultdict(list)
    for k, (s, _) in enumerate(reps):
        for g in s:
            index[g].append(k)
    for k, (s, i) in enumerate(reps):
        common = Counter(o for g in s for o in index[g] if o > k)
        for o, c in common.items():
            if den * c >= num * (len(s) + len(reps[o][0]) - c):
                a, b = sorted((find(i), find(reps[o][1])))
                up[b] = a
    least = {}
    for i in sets:
        r = find(i)
        least[r] = min(least.get(r, i), i)
    return {i: (len(sets[i]), least[find(i)]) for i in sets}


def repeated_spans(texts: list, length: int) -> list[tuple]:
    """(maximal removed [start, stop), bytes left) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[p:p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if counts[d[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        spans, start = [], None
        for i, g in enumerate([*gone, False]):
            if g and start is None:
                start = i
            if not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def hard_negatives(rows: list, is_anchor, k: int = 5) -> list[tuple]:
    """Sorted (anchor, positive, rank, negative, positive score, negative score) of (id, vector, label) rows."""
    import math

    ok = {(i, tuple(math.floor(256.0 * x) for x in v), y) for i, v, y in rows
          if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, a, y in ok:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, z) for j, b, z in ok)
        for p, j in [(-s, j) for s, j, z in scored if z == y and j != i][:k]:
            for rank, (s, n) in enumerate([(-s, n) for s, n, z in scored if z != y and 80 * p <= -100 * s <= 100 * p][:k], 1):
                out.append((i, j, rank, n, p, s))
    return sorted(out)


_NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest_edits(rows: list) -> tuple[int, str]:
    """(cost, audit) of (initial, fault) rows by a dynamic program over suffixes; faults: 1 blank, 2 duplicate, 3 truncated."""
    best = {"": (0, ""), "a": (0, "")}

    def inserts(best):
        for _ in range(4):
            for s in ("", "s", "u", "a"):
                t = _NEXT.get((s, "u")) or _NEXT.get((s, "a"))
                if t in best:
                    best[s] = min(best.get(s, (10 ** 9, "")), (best[t][0] + 3, "I" + best[t][1]))
        return best

    best = inserts(best)
    for initial, fault in reversed(rows):
        now = {}
        for s in ("", "s", "u", "a"):
            ways = [(4, "D", s)]
            if fault not in (1, 2):
                more = 3 * (fault == 3)
                if initial == "" or (s, initial) in _NEXT:
                    ways.append((more, "K", _NEXT[s, initial] if initial else s))
                ways += [(3 + more, "R", _NEXT[s, r]) for r in "ua" if (s, r) in _NEXT]
            ways = [(c + best[t][0], e + best[t][1]) for c, e, t in ways if t in best]
            if ways:
                now[s] = min(ways)
        best = inserts(now)
    return best[""]


def conversations(rows: list) -> list[tuple]:
    """The contract's row of each conversation of (conv_id, turn, role, text) rows."""
    import zlib

    told = defaultdict(list)
    for conv, turn, role, text in rows:
        told[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        told[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, said in told.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in said:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = cheapest_edits([(r[1][:1], f) for r, f in zip(said, faults)])
        state, left, kept = "", iter(said), []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            if edit != "K":
                role = "user" if (state, "u") in _NEXT else "assistant"
            state = _NEXT[state, role[0]] if role else state
            kept.append(f"{role}:{text}")
        turns = {r[0] for r in said} - {None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (1, 2, 3)],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])), cost, audit,
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out
