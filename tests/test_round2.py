"""Behaviour that no longer depends on folder names, constant dates, prefixes or cached settings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


def test_panel_ends_with_the_data(spark, tmp_path):
    from caseload.plans.panel import monthly_facts

    day = dt.date
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    table("orders", [(1, 7, day(2001, 6, 3)), (2, 7, day(2003, 2, 9)), (3, 8, day(2002, 12, 1))], "o_orderkey long, o_custkey long, o_orderdate date")
    table("lineitem", [(k, 1, 2.0, 10.0, 0.1, "N", "O") for k in (1, 2, 3)],
          "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    table("part", [(1, "PROMO")], "p_partkey long, p_type string")
    out = monthly_facts(spark, str(tmp_path)).groupBy("customer_public_id").agg(F.max("transaction_month").alias("end"), F.count("*").alias("n")).collect()
    assert {r.customer_public_id: (r.end, r.n) for r in out} == {"7": (day(2003, 2, 1), 21), "8": (day(2003, 2, 1), 3)}


def test_stages_follow_their_settings(spark):
    from caseload.config import S2Config
    from caseload.plans import workflows as W

    small = "/root/testdata/sf0.001"
    total = lambda cfg: W.peer_frame(spark, small, cfg).agg(F.sum("channel_s2_score")).first()[0]
    one = total(S2Config())
    assert total(S2Config(zero_order_bonus=5.0)) > one and total(S2Config()) == one


def test_all_labels_review_a_case(spark):
    from caseload.plans.q_outcomes import reviews

    small = "/root/testdata/sf0.001"
    got = reviews(spark, small).where("review_outcome <> ''")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert got.select("doc_id").distinct().count() == labels.select("doc_id").distinct().count()


def test_checkpoint_folder_is_required_off_local(spark):
    from caseload.session import ensure_checkpoint_dir

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                sc = staticmethod(lambda: type("sc", (), {"getCheckpointDir": staticmethod(lambda: type("o", (), {"isDefined": staticmethod(lambda: False)}))}))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())


def test_constant_column_is_one_bin(spark):
    from caseload.operators.explore import histogram

    rows = histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), "x", 10).collect()
    assert [(r.bin, r.rows) for r in rows] == [(0, 2)]


def test_reconcile_statuses(spark):
    from caseload.operators.audit import reconcile

    m = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 5, "a"), (4, None, None), (5, None, None), (6, 5, None)], "k long, bytes long, sha256 string")
    live = spark.createDataFrame([(1, 5, "a"), (2, 6, "a"), (3, 5, "b"), (5, 9, "z"), (6, 5, "q"), (7, None, None)], "k long, bytes long, sha256 string")
    got = {r.k: r.status for r in reconcile(m, live, "k").collect()}
    assert got == {1: "ok", 2: "stale_size", 3: "stale_hash", 4: "missing", 5: "ok", 6: "ok", 7: "extra"}


def test_links_resolve_against_page_and_host(spark):
    from caseload.operators.audit import broken_links

    html = "".join(f'<a href="{x}">' for x in ("b.html", "./b.html#top", "../docs/b.html?q=1", "/docs/a.html", "c.html", "/b.html",
                                              "http://two.example/docs/a.html", "http://one.example/docs/gone.html", "#x", "mailto:a@b.c", "?page=2", "//two.example/x.html"))
    pages = spark.createDataFrame([(1, "http://one.example/docs/a.html", html), (2, "http://one.example/docs/b.html", ""),
                                   (3, "http://two.example/x.html", '<a href="/docs/a.html"><a href="y/">')], "page_id long, url string, html string")
    got = {(r.page_id, r.target) for r in broken_links(pages).collect()}
    assert got == {(1, "c.html"), (1, "/b.html"), (1, "http://one.example/docs/gone.html"), (1, "http://two.example/docs/a.html"), (3, "/docs/a.html"), (3, "y/")}


def test_local_path_patterns(spark):
    from caseload.config import LOCAL_PATH_PATTERNS
    from caseload.operators.audit import pattern_findings

    texts = ["see /home/ann/notes.txt", r"C:\temp is drive", "file:///srv/x", "a normal /path/to", "https://example.org/home"]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "source string, id long, text string")
    got = {(r.id, r.pattern_id) for r in pattern_findings(df, LOCAL_PATH_PATTERNS).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}


def test_cell_medians_with_a_hot_cell(spark):
    import random
    import statistics

    from caseload.operators.ranking import cell_medians

    rng = random.Random(1)
    rows = [(None if i % 10 == 0 else "hot" if i % 10 < 9 else f"c{i % 7}", 1, None if i % 13 == 0 else float(rng.choice((0, 1, 2, rng.random() * 50))), float(i)) for i in range(5000)]
    rows.append(("empty", 1, None, None))
    df = spark.createDataFrame(rows, "cell string, m int, x double, y double")
    got = {r.cell: (r.median_x, r.median_y) for r in cell_medians(df, ["cell", "m"], ["x", "y"], buckets=8).collect()}
    want = {}
    for cell in {r[0] for r in rows}:
        v = [[r[k] for r in rows if r[0] == cell and r[k] is not None] for k in (2, 3)]
        want[cell] = tuple(statistics.median(x) if x else None for x in v)
    assert got == want
