import random

import numpy as np
import pytest
from caseload.llm import decontam as D


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(0, 80))] for _ in range(2))
        assert D.lcs_length(a, b) == longest(a, b)


def text(rng, n, common=("the", "of", "and", "to", "in")):
    return [rng.choice(common) if rng.random() < 0.4 else f"{rng.choice('bdfgkl')}{rng.choice('aeiou')}{rng.choice('mnrst')}{rng.randrange(400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def case(spark):
    """Items; documents with verbatim, re-cased, re-punctuated and reworded items; clean documents."""
    rng = random.Random(2)
    items = [(k, (lambda w: " ".join(w[:-6]) + ". " + " ".join(w[-6:]) + ".")(text(rng, rng.randrange(18, 60)))) for k in range(40)]
    docs, want = [], set()
    for i in range(300):
        w = text(rng, rng.randrange(0, 600))
        if i % 3 == 0:
            k = rng.randrange(40)
            part = items[k][1].split()
            if i % 4 == 1:
                part = [x.upper().replace(".", " ;") for x in part]
            elif i % 4 == 2:  # one word in seven replaced, some words put in
                part = [rng.choice(["the", "and", "of"]) if rng.random() < 0.14 else x for x in part]
                part.insert(3, "inserted")
            at = rng.randrange(len(w) + 1)
            w[at:at] = part
            want.add((i, k))
        docs.append((i, "\n".join(" ".join(w[j:j + 90]) for j in range(0, len(w), 90))))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), want


def test_finds_items_and_rewordings_and_leaves_clean_documents(case):
    docs, items, want = case
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    assert not got - want
    exact = {x for x in want if x[0] % 4 != 2}
    assert exact <= got and len(got & want) >= 0.95 * len(want)


def test_blocks_of_items(case, monkeypatch):
    docs, items, want = case
    whole = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    monkeypatch.setattr(D, "ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == whole


def test_recall_of_the_latent_search(spark):
    """Candidates against full TF-IDF cosines, at production rank and with more items than that."""
    rng = random.Random(3)
    given = [(k, " ".join(text(rng, rng.randrange(16, 60)))) for k in range(D.ITEMS)]
    docs = [" ".join(text(rng, 200) + given[rng.randrange(D.ITEMS)][1].split()[:rng.randrange(8, 60)] + text(rng, 100)) for _ in range(200)]
    items, frame = spark.createDataFrame(given, "item_id long, text string").repartition(3), spark.createDataFrame([(t,) for t in docs], "text string")
    terms = sorted({w for _, t in given for w in D.words_of(t)})
    counts, n = D.document_frequencies(frame, terms)
    index = D.Index({w: i for i, w in enumerate(terms)}, np.log((n + 1.0) / (counts + 0.5)).clip(0.01), float(np.log(2.0 * (n + 1))))
    full = D.Search(index, np.eye(len(terms), dtype=np.float32), given, {"cosine": 0.5})
    space = D.randomised_svd(items, index)
    np.testing.assert_allclose(space.T @ space, np.eye(D.RANK), atol=1e-4)
    latent = D.Search(index, space, given, {"cosine": D.COSINE})
    tokens = [D.words_of(t) for t in docs]
    wanted, found = ({x[:3] for x in s.candidates(tokens)} for s in (full, latent))
    assert len(wanted) > 150 and len(wanted & found) >= 0.97 * len(wanted)


def test_document_frequencies(case):
    docs, items, _ = case
    counts, n = D.document_frequencies(docs, ["the", "inserted", "nowhere"])
    texts = [set(D.words_of(r.text)) for r in docs.collect()]
    assert n == 300 and list(counts) == [sum(w in t for t in texts) for w in ("the", "inserted", "nowhere")]


def test_messy_rows(spark, messy, none, messy_list):
    items = spark.createDataFrame([(1, messy_list[0][1][:200]), (2, None), (3, ""), (None, "lonely text without an id"), (5, "!!!"), (6, messy_list[0][1][:200])], "item_id long, text string")
    out = D.find_matches(messy, items)
    assert out.count() == len(messy_list) and set(out.columns) == set(messy.columns)
    hits = {(r.doc_id, r.item_id) for r in D.contaminated(messy, items).collect()}
    assert {(1, 1), (1, 6), (2, 1), (3, 1), (4, 1), (None, 1), (None, None)} <= hits
    assert not {d for d, _ in hits} & {6, 7, 8, 12, *range(20, 40)}
    assert D.contaminated(none, items).count() == 0 and D.contaminated(messy, items.where("false")).count() == 0
    kept = D.decontaminate(messy.drop("matches"), items)
    assert kept.columns == messy.drop("matches").columns and kept.where("doc_id = 1").count() == 0 and kept.where("doc_id = 6").count() == 1


@pytest.mark.parametrize("n_words", [15, 500])
@pytest.mark.parametrize("total", [10_000, 10_000_000])
def test_verbatim_copies_are_candidates_at_any_size(spark, n_words, total):
    """Items of common and rare words, whole in hosts of the same words and in hosts of words that no item has."""
    rng = random.Random(n_words)
    common, rare = [f"c{k}" for k in range(200)], [f"r{k}" for k in range(40_000)]
    words = lambda n: [rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(n)]
    given = [(k, " ".join(words(n_words))) for k in range(D.ITEMS)]
    given += [(1000 + k, " ".join(rng.choice(common) for _ in range(n_words))) for k in range(0 if n_words > 15 else 4)]
    terms = sorted({w for _, t in given for w in D.words_of(t)})
    counts = np.array([total * 0.5 / (1 + int(w[1:])) ** 0.7 if w[0] == "c" else total * 1e-5 for w in terms]).astype(int)
    index = D.Index({w: i for i, w in enumerate(terms)}, np.log((total + 1.0) / (counts + 0.5)).clip(0.01), float(np.log(2.0 * (total + 1.0))))
    space = D.randomised_svd(spark.createDataFrame(given, "item_id long, text string").repartition(3), index)
    search = D.Search(index, space, given, {"cosine": D.COSINE, "lcs": D.LCS, "weight": D.WEIGHT, "answer": D.ANSWER})
    texts = []
    for _, t in given:
        for host in (words(400), [f"z{rng.randrange(10 ** 6)}" for _ in range(400)]):
            cut = rng.randrange(400)
            texts.append(" ".join([*host[:cut], t, *host[cut:]]))
    found = search.matches(texts)
    assert [k for k, ms in enumerate(found) if given[k // 2][0] not in {m[0] for m in ms}] == []


def test_words_are_those_of_the_expression():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(128, 0x500), rng.randrange(0x2000, 0x3100), rng.randrange(0x10000, 0x10500), 0x130, 0xB2, 0x660, 0x5F, 0xD800]))
                       for _ in range(12))
        assert D.words_of(text) == D._WORD.findall(text.lower())


def test_a_column_named_matches_stays(spark):
    docs = spark.createDataFrame([(1, "nothing here", "mine"), (2, ITEM_TEXT, "yours")], "doc_id long, text string, matches string")
    bench = spark.createDataFrame([(7, ITEM_TEXT)] * 3, "item_id long, text string")
    assert [tuple(r) for r in D.decontaminate(docs, bench).collect()] == [(1, "nothing here", "mine")]
    assert [(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()] == [(2, 7)]


ITEM_TEXT = "Which river passes the old mill of the northern province before it reaches the wide eastern bay and the harbour town? The answer is the Alder."


def test_block_sums_are_those_of_reduceat_in_less_time():
    import time

    rng = np.random.default_rng(4)
    rows, sizes = rng.normal(size=(500, 192)).astype(np.float32), rng.integers(1, 60, 4000)
    at, starts = rng.integers(0, 500, sizes.sum()), np.cumsum(sizes) - sizes
    began = time.process_time()
    want = np.add.reduceat(rows[at], starts)
    between = time.process_time()
    got = D.block_sums(rows, at, starts)
    assert time.process_time() - between < (between - began) / 2
    assert np.array_equal(got, want) and D.block_sums(rows, at[:0], starts[:0]).shape == (0, 192)
    for most in (2, 9, 18, 400):
        starts = np.cumsum(sizes := rng.integers(1, most, 90)) - sizes
        assert np.array_equal(D.block_sums(rows, at[:sizes.sum()], starts), np.add.reduceat(rows[at[:sizes.sum()]], starts))


def test_words_of_other_letters():
    for text in ("Éeau aiê çaiment 12", "eau — çà, l’été…", "漢字 かな 7x", "a\u0301b é_è"):
        assert D.words_of(text) == D._WORD.findall(text.lower())
