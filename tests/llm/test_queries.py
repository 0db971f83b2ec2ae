"""Registered queries against DuckDB SQL and plain Python, and the pipeline stage by stage."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import brute
import corpus_pipeline as C
from caseload.llm import queries as Q

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # enough labels to learn from
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


def test_all_are_registered():
    names = E.queries()
    assert [n for n in Q.QUERIES if n.startswith("op")] == list(Q.QUERIES) and len(Q.QUERIES) == 13
    assert set(Q.QUERIES) | {"pipeline"} <= set(names) and set(Q.SQL) <= set(E.oracle_sql())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_sql(spark, con, name):
    want = con.execute(Q.SQL[name]).df()
    got = Q.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda x: sorted(map(tuple, x[sorted(want.columns)].astype(object).where(x[sorted(want.columns)].notna(), None).values.tolist()), key=repr)
    assert rows(got) == rows(want)


def test_contracts_without_sql(spark, docs):
    one = Q.op1_sharding(spark, SF).toPandas()
    assert len(one) == len(docs) and set(one.law) == {"bytes"} and one.grown_shard.isna().all() and one.shard.between(0, 15).all()
    nine = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.op9_quality_rules(spark, SF).collect()}
    assert nine == {i: brute.statistics(t) for i, t in docs}
    three = Q.op3_toxicity(spark, SF).toPandas()
    assert len(three) == len(docs) and three.score.between(0, 1).all() and ((three.score >= 0.7) == (three.predicted == 1)).all()


def test_pipeline(spark):
    """Each stage on what its predecessor kept; decisions checked against plain Python."""
    table = spark.read.parquet(f"{LARGER}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        out = stage(spark, table, LARGER)
        if name != "packing":
            assert out.columns == table.columns
        rows = {r.doc_id: r for r in out.collect()} if name != "packing" else out.toPandas()
        before = {r.doc_id: r.text for r in table.collect()}
        if name == "toxicity":
            assert 0.7 * len(before) < len(rows) < len(before)
        elif name == "line_dedup":
            want = {i: t for i, _, _, t in brute.line_dedup(list(before.items()))}
            assert {i: r.text for i, r in rows.items()} == want and all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "near_duplicates":
            assert set(rows) == {i for i, (_, c) in brute.components(list(before.items()), 5, 80).items() if i == c}
        elif name == "decontamination":
            items = [" ".join(brute.words(brute.lower(t))) for (t,) in duckdb.execute(f"SELECT text FROM '{LARGER}/benchmark.parquet'").fetchall()]
            held = {i for i, t in before.items() if any(x in " ".join(brute.words(brute.lower(t))) for x in items)}
            assert set(rows) == set(before) - held
        else:
            assert set(rows.doc_id) == set(before)
            filled = rows.groupby("sequence_id").length.sum()
            assert filled.max() <= 2048 and len(filled) <= np.ceil(rows.length.sum() / 2048) + 2
        kept[name] = len(rows)
        if name != "packing":
            table = _written(out)
    assert list(kept) == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert C.run(spark, LARGER).count() == kept["packing"]


def _written(df):
    from caseload.llm.common import stash

    return stash(df, "test-stage")


def test_empty_documents_through_the_pipeline(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_pipeline_keeps_columns_of_any_name(spark):
    """Columns of documents that are named like an operator's stay as they are; n_chars may be absent."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    mine = table.drop("n_chars").selectExpr("*", "42.0D AS score", "'p' AS predicted", "-1 AS held_out", "-7 AS n_lines", "'d' AS n_dropped", "'m' AS matches", "'s' AS sid", "1 AS code")
    docs = mine
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == mine.columns, name
    kept = docs.collect()
    assert kept and all((r.score, r.predicted, r.held_out, r.n_lines, r.n_dropped, r.matches, r.sid, r.code) == (42.0, "p", -1, -7, "d", "m", "s", 1) for r in kept)
