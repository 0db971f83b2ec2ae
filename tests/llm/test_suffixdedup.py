"""Repeated spans against brute force, the loser tree against sorting, front coding as a round trip."""

import random

import numpy as np
import pytest

import brute
from caseload.llm import suffixdedup as S


def _rows(out):
    return sorted((tuple(r[c] for c in ("doc_id",)), [tuple(s) for s in r.removed], bytes(r.kept)) for r in out.collect())


def _texts(rng, n, alphabet="ab", passages=6):
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 60))) for _ in range(passages)]
    out = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 7))]
        out.append((i, "".join(parts)))
    return out + [(n, None), (n + 1, ""), (n + 2, "a" * 90), (n + 3, "xyz" * 30), (n + 4, out[3][1]), (None, out[3][1]), (n + 5, "é漢" * 20)]


@pytest.mark.parametrize("length", [2, 7, 16, 30])
def test_against_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 64)  # texts are cut, anchors go on over pieces
    monkeypatch.setattr(S, "MERGE_BYTES", 3000)  # several merging tasks
    monkeypatch.setattr(S, "SENT_ROWS", 10)  # shuffle joins
    docs = _texts(random.Random(length), 70, "ab" if length > 7 else "abcdefgh")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, [(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in S.dedup_spans(df, length).collect()), key=repr)
    want = sorted(((i, *brute.repeated_spans([t for _, t in docs], length)[n]) for n, (i, _) in enumerate(docs)), key=repr)
    assert got == want


def test_messy_and_empty(spark, messy, messy_list, none):
    out = S.dedup_spans(messy.withColumnRenamed("kept", "removed"), 40)
    assert S.dedup_spans(none, 40).count() == 0 and out.columns[-2:] == ["removed", "kept"] and "n_chars" in out.columns
    got = sorted(((r.doc_id, [(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in out.collect()), key=repr)
    spans = brute.repeated_spans([t for _, t in messy_list], 40)
    assert got == sorted(((i, *spans[n]) for n, (i, _) in enumerate(messy_list)), key=repr)


def test_runs_and_loser_tree():
    rng = random.Random(3)
    for k in (1, 2, 3, 5, 8):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 12))) for _ in range(rng.randrange(0, 20))) for _ in range(k)]
        coded = [S.front_code([(s,) for s in run]) for run in runs]
        assert [[s for _, s in S.front_decode(*c)] for c in coded] == runs
        out = S.merge_runs([((n, s, None) for n, s in S.front_decode(*c)) for c in coded])
        strings = [x[1] for x in out]
        assert strings == sorted(s for run in runs for s in run)
        assert [x[0] for x in out] == [S.common_prefix(a, b) for a, b in zip([b"", *strings], strings)]


def test_known_prefixes_are_not_compared_again():
    """Each byte that the loser tree reads lies behind the known prefix."""
    long = b"x" * 4000
    runs = [[(0 if i == 0 else 4000, long + bytes([65 + 2 * i + r]), None) for i in range(8)] for r in range(2)]
    seen = []
    real = S.common_prefix
    S.common_prefix = lambda a, b, known=0: (seen.append(known), real(a, b, known))[1]
    try:
        S.merge_runs(runs)
    finally:
        S.common_prefix = real
    assert seen[0] == 0 and all(n >= 4000 for n in seen[1:])


def test_anchors_of_copies_agree():
    rng = np.random.default_rng(0)
    shared = rng.integers(97, 123, 500, dtype=np.uint8).tobytes()
    texts = [(0, rng.integers(97, 123, 333, dtype=np.uint8).tobytes() + shared), (1, shared + b"tail" * 200)]
    tool = S.Hasher(400)
    found = []
    for _, text in texts:
        tool.load(text)
        begin = text.index(shared)
        starts = np.arange(begin, begin + 101)
        found.append((tool.anchors(starts) - begin, tool.strings(tool.anchors(starts), tool.context), tool.strings(starts, 400)))
    assert all((a == b).all() for a, b in zip(*found))


def test_length_is_checked(spark, none):
    with pytest.raises(ValueError):
        S.dedup_spans(none, 1)


def test_anchors_hold_few_bytes_for_each_byte_of_text():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = [(i, bytes(rng.integers(97, 123, 40_000, np.uint8))) for i in range(100)]
    tracemalloc.start()
    starts = sum(int((high - low + 1).sum()) for _, _, low, high, _ in S._anchor_rows(iter(texts), 400))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert starts == 100 * (40_000 - 399) and peak < 80 << 20  # 250 MB with pieces of 2 MB


def test_tables_go_when_they_were_read_for_the_last_time(spark, monkeypatch):
    """Of the scratch tables, only those that a later step reads are there when the strings have been counted."""
    from pathlib import Path

    paths, there = {}, []
    real = S.stash

    def watched(df, name):
        out = real(df, name)
        paths[name] = Path(out._stash_path.removeprefix("file:"))
        if name == "suffix-twice":
            there.extend(sorted(n for n, p in paths.items() if p.exists()))
        return out

    monkeypatch.setattr(S, "stash", watched)
    docs = _texts(random.Random(2), 30, "abcdefgh")
    assert S.dedup_spans(spark.createDataFrame(docs, "doc_id long, text string"), 16).count() == len(docs)
    assert {"suffix-settled", "suffix-strings", "suffix-twice"} <= set(there)
    assert not {"suffix-anchors", "suffix-again", "suffix-kept", "suffix-texts", "suffix-matches", "suffix-asked"} & set(there)
