import random

import brute
from caseload.llm import secrets as S
from pyspark.sql import functions as F


def spans(frame):
    return frame.select("*", S.span_text().alias("spans"))


def test_rows(messy, none, messy_list):
    out, _ = S.scan_secrets(messy)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = sorted(((r.doc_id, r.spans) for r in spans(out).collect()), key=key)
    want = sorted(((i, brute.secrets(t)["spans"]) for i, t in messy_list), key=key)
    assert got == want and any(s for _, s in want)
    empty, ledger = S.scan_secrets(none)
    assert empty.count() == 0 and ledger.count() == 0


def test_random_texts(spark):
    rng = random.Random(8)
    pieces = ["password", "Token", "SECRET", "api_key", "apikey", "=", ": ", '"', "'", " ", "\n", "AKIA", "ABCDEFGHIJKLMNOPQR", "0123456789ab", "deadbeef", "é🙂", "-", "x", "ſecret", "toKen"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40)))) for i in range(600)]
    out, _ = S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.spans for r in spans(out).collect()}
    bad = [(i, t, got[i], brute.secrets(t)["spans"]) for i, t in rows if got[i] != brute.secrets(t)["spans"]]
    assert not bad, bad[0]


def test_ledger_is_incremental(spark):
    first = spark.createDataFrame([(1, "token = abcdef"), (2, "nothing"), (3, "token = abcdef")], "doc_id long, text string")
    out, ledger = S.scan_secrets(first)
    assert ledger.count() == 2 * len(S.RULES)  # two blobs
    assert {r.doc_id: r.spans for r in spans(out).collect()} == {1: "assign:0:14", 2: "", 3: "assign:0:14"}
    # a doctored finding shows that seen blobs are not scanned again
    known = ledger.withColumn("spans", F.when(F.size("spans") > 0, F.expr("array(named_struct('start', 7, 'end', 9))")).otherwise(F.col("spans")))
    later = spark.createDataFrame([(4, "token = abcdef"), (5, "secret: 123456")], "doc_id long, text string")
    out, after = S.scan_secrets(later, known)
    assert {r.doc_id: r.spans for r in spans(out).collect()} == {4: "assign:7:9", 5: "assign:0:14"}
    assert after.count() == 3 * len(S.RULES)
    # a new version of one rule rescans with that rule alone
    newer = (S.Rule("assign", S.RULES[0].pattern, 2, 7, "2"), *S.RULES[1:])
    out, again = S.scan_secrets(later, after, newer)
    assert again.count() == after.count() + 2
    assert {r.doc_id: r.spans for r in out.select("*", S.span_text(newer).alias("spans")).collect()} == {4: "", 5: ""}
