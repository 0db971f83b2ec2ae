import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, key string, row int, size int, part int, "
          "label string, score double, matches string, n_lines int, kept string, bucket int, code long, sid long, grp string")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def messy_rows():
    """Nulls, empty and very long texts, copies, near copies, repeated rows and ids, ties, shared lines."""
    rng = random.Random(5)
    base = " ".join(words(rng, 300))
    line = "All rights reserved by the honourable society of line writers."
    texts = [
        (1, base), (2, base), (3, base.upper()), (4, base + " tail"), (5, base.replace("w1x", "w2x", 1)), (6, None), (7, ""), (8, " \t\n\x0b\f\r "),
        (9, "one"), (10, "ONE"), (11, "one two"), (12, " ".join(words(rng, 30_000, 5000))), (None, base), (None, None), (None, "lonely text without an id"),
        (13, "a b c a b c a b c"), (13, "a b c a b c a b c"), (13, "another text under the same id"), (14, "é ü 漢字 🙂 password = hunter2!x"),
        (15, 'api_key: "AKIA' + "B" * 20 + '" and ' + "0123456789abcdef" * 3 + " token=short token: abcdefgh"), (16, "line\n" * 50), (17, "\n\n\n"),
    ]
    for i in range(20, 40):
        own = " ".join(words(rng, 60 + i))
        texts.append((i, "\n".join([own[:200], line if i % 2 else "  " + line.upper() + "\t", own[200:], line])))
    for i in range(40, 70):
        part = base.split()
        for _ in range(rng.randrange(1, 25)):
            part[rng.randrange(len(part))] = f"edit{rng.randrange(10 ** 6)}"
        texts.append((i, " ".join(part)))
    return [(i, t, None if n % 7 == 0 else "en", None if n % 5 == 0 else "s", None, 0, "k", 1, 2, 3, "l", 0.5, "m", 4, "x", 5, 6, 7, "g")
            for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "messy")
    spark.createDataFrame(messy_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def messy_list():
    return [(r[0], r[1]) for r in messy_rows()]


@pytest.fixture(scope="session")
def none(messy):
    return messy.where("false")
