"""Registered queries: audit jobs over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import (ALLOWED_DIRECTORY_SUFFIXES, EXCLUDED_NAMES, EXCLUDED_SUFFIXES, FORBIDDEN_ARCHIVE_PARTS,
                             FORBIDDEN_ARCHIVE_SUFFIXES, FORBIDDEN_OUTPUT_TOKENS, LOCAL_PATH_PATTERNS)
from caseload.operators import audit as AU
from caseload.plans.oracle import cte, with_ctes
from caseload.sources.tables import read_table


# Marks put into rows chosen by the md5 of their key, so that every token, pattern and decision occurs.
_MARKS = [f" {t.upper()} " for t in FORBIDDEN_OUTPUT_TOKENS] + [" /home/ann/x ", r" D:\\work ", " file:///srv/x "]


def _planted(key, text):
    """``text`` with a mark if the first two hex digits of the key's md5 name one."""
    digit = F.conv(F.substring(F.md5(key), 1, 2), 16, 10).cast("int")
    return F.concat(text, F.coalesce(F.get(F.array(*[F.lit(m) for m in _MARKS]), digit), F.lit("")))


def _planted_sql(key, text):
    marks = "[" + ", ".join(f"'{m}'" for m in _MARKS) + "]"
    return f"{text} || coalesce({marks}[('0x' || substr(md5({key}), 1, 2))::INT + 1], '')"


def texts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select(F.lit("documents").alias("source"),
                                                                         F.col("doc_id").cast("string").alias("id"), "text")
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"]).select(
        F.lit("conversations").alias("source"), F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"]).select(F.lit("pages").alias("source"),
                                                                      F.col("page_id").cast("string").alias("id"), F.col("html").alias("text"))
    return d.unionByName(c).unionByName(p).withColumn("text", _planted(F.concat_ws("|", "source", "id"), F.col("text")))


cte("texts")(f"""
  SELECT source, id, {_planted_sql("source || '|' || id", "text")} AS text FROM (
    SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS id, text FROM documents
    UNION ALL SELECT 'conversations', conv_id || '/' || turn, text FROM conversations
    UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), html FROM pages) t""")


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_TOK_VALUES = ", ".join(f"('{t}')" for t in FORBIDDEN_OUTPUT_TOKENS)
_A1_SQL = with_ctes(f"""
SELECT s.source, k.token, s.rows_scanned, coalesce(f.n, 0) AS rows_with_finding
FROM (SELECT source, count(*) AS rows_scanned FROM texts GROUP BY source) s
CROSS JOIN (VALUES {_TOK_VALUES}) k(token)
LEFT JOIN (SELECT source, token, count(DISTINCT id) AS n FROM texts CROSS JOIN (VALUES {_TOK_VALUES}) t(token)
           WHERE instr(lower(text), token) > 0 GROUP BY source, token) f USING (source, token)""", "texts")

from caseload.plans.registry import query  # noqa: E402


@query("a01_forbidden_token_scan", _A1_SQL)
def a01_forbidden_token_scan(spark, sf_dir):
    """A1: forbidden-token findings per source x token (lower-cased containment)."""
    t = texts(spark, sf_dir)
    return AU.findings_summary(t, AU.token_findings(t), "token", list(FORBIDDEN_OUTPUT_TOKENS))


_PAT_VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(LOCAL_PATH_PATTERNS))


@query("a02_local_path_scan", with_ctes(f"""
SELECT s.source, CAST(k.pattern_id AS BIGINT) AS pattern_id, s.rows_scanned, coalesce(f.n, 0) AS rows_with_finding
FROM (SELECT source, count(*) AS rows_scanned FROM texts GROUP BY source) s
CROSS JOIN (VALUES {_PAT_VALUES}) k(pattern_id, pattern)
LEFT JOIN (SELECT source, pattern_id, count(DISTINCT id) AS n FROM texts CROSS JOIN (VALUES {_PAT_VALUES}) t(pattern_id, pattern)
           WHERE regexp_matches(text, pattern) GROUP BY source, pattern_id) f USING (source, pattern_id)""", "texts"))
def a02_local_path_scan(spark, sf_dir):
    """A2: machine-local path pattern findings per source x pattern."""
    t = texts(spark, sf_dir)
    return AU.findings_summary(t, AU.pattern_findings(t, LOCAL_PATH_PATTERNS), "pattern_id", list(range(len(LOCAL_PATH_PATTERNS))))


@query("a03_json_cell_scan", """
SELECT event_type, count(*) AS rows, count(k) AS parsed_rows,
       CAST(sum(CASE WHEN props IS NOT NULL AND k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failed_rows,
       min(k) AS min_k, max(k) AS max_k, CAST(sum(k) AS BIGINT) AS sum_k
FROM (SELECT event_type, props,
             CASE WHEN json_valid(props) THEN TRY_CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events) e
GROUP BY event_type""")
def a03_json_cell_scan(spark, sf_dir):
    """A3: semi-structured JSON column parsed with an explicit schema, per event type."""
    return AU.json_cells(read_table(spark, sf_dir, "events", ["event_type", "props"]))


def _decision_sql(path):
    parts = f"string_split({path}, '/')"
    name = f"{parts}[-1]"
    suffix = f"lower(regexp_extract({name}, '(\\.[^.]+)$', 1))"
    return f"""CASE WHEN list_has_any({parts}, {list(FORBIDDEN_ARCHIVE_PARTS)}) THEN 'forbidden_part'
            WHEN list_has_any({parts}, {list(EXCLUDED_NAMES)}) THEN 'excluded_name'
            WHEN {name} = '.env' THEN 'env_file'
            WHEN {suffix} IN {_in(FORBIDDEN_ARCHIVE_SUFFIXES)} THEN 'forbidden_suffix'
            WHEN {suffix} IN {_in(EXCLUDED_SUFFIXES)} THEN 'excluded_suffix'
            WHEN {suffix} NOT IN {_in(ALLOWED_DIRECTORY_SUFFIXES)} THEN 'suffix_not_allowed'
            ELSE 'allowed' END""", suffix


_DEC, _SUF = _decision_sql("path")
# ends put on paths chosen by the md5 of the page id: every decision occurs
_ENDS = ["/notes.md", "/run.py", "/__pycache__/m.py", "/.DS_Store", "/data.parquet", "/m.pyo", "/.cache/x.md", "/readme.txt"]
_ENDS_SQL = f"coalesce({_ENDS}[('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 1))::INT + 1], '')"


@query("a04_inventory_filter", f"""
SELECT suffix, decision, decision = 'allowed' AS allowed, count(*) AS paths FROM (
  SELECT {_SUF} AS suffix, {_DEC} AS decision
  FROM (SELECT regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) || {_ENDS_SQL} AS path FROM pages) p) d
GROUP BY 1, 2, 3""")
def a04_inventory_filter(spark, sf_dir):
    """A4: allow/deny decisions of the page paths by suffix, directory part and name."""
    digit = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 1), 16, 10).cast("int")
    end = F.coalesce(F.get(F.array(*[F.lit(x) for x in _ENDS]), digit), F.lit(""))
    p = read_table(spark, sf_dir, "pages", ["page_id", "url"]).select(F.concat(AU.url_path(), end).alias("path"))
    d = AU.inventory_decision(p)
    return d.groupBy("suffix", "decision", "allowed").agg(F.count(F.lit(1)).alias("paths"))


@query("a05_duplicate_content", """
SELECT sha256, count(*) AS copies, min(doc_id) AS first_doc_id FROM (SELECT doc_id, sha256(text) AS sha256 FROM documents) d
GROUP BY sha256 HAVING count(*) > 1""")
def a05_duplicate_content(spark, sf_dir):
    """A5: duplicated members (documents with identical content hash)."""
    inv = AU.content_inventory(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")
    return inv.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc_id")) \
        .where(F.col("copies") > 1)


@query("a06_content_hash_inventory", """
SELECT doc_id, text IS NOT NULL AS available, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents""")
def a06_content_hash_inventory(spark, sf_dir):
    """Content-hash inventory (available, bytes, SHA-256) of every document."""
    return AU.content_inventory(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")


@query("a07_inventory_reconciliation", """
WITH live AS (
  SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents
), recorded AS (
  SELECT CASE WHEN h = '2' THEN -1 - doc_id ELSE doc_id END AS doc_id, CASE h WHEN '0' THEN bytes + 1 WHEN '3' THEN NULL ELSE bytes END AS bytes,
         CASE h WHEN '1' THEN sha256(sha256) WHEN '3' THEN NULL ELSE sha256 END AS sha256
  FROM (SELECT l.*, substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 1) AS h FROM live l WHERE doc_id IN (SELECT doc_id FROM labels)) x
)
SELECT status, count(*) AS items FROM (
  SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN m.doc_id IS NULL THEN 'extra' WHEN m.bytes <> l.bytes THEN 'stale_size'
              WHEN m.sha256 <> l.sha256 THEN 'stale_hash' ELSE 'ok' END AS status
  FROM recorded m FULL JOIN live l ON m.doc_id = l.doc_id) s
GROUP BY status""")
def a07_inventory_reconciliation(spark, sf_dir):
    """A recorded inventory of the labelled documents, with sizes, hashes and ids spoilt in rows chosen by
    md5, reconciled with the live documents: missing / extra / stale size / stale hash / ok counts."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    live = AU.content_inventory(docs, "doc_id", "text").select("doc_id", "bytes", "sha256")
    h = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    recorded = live.join(read_table(spark, sf_dir, "labels", ["doc_id"]).distinct(), "doc_id", "left_semi").select(
        F.when(h == "2", -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(h == "0", F.col("bytes") + 1).when(h != "3", F.col("bytes")).alias("bytes"),
        F.when(h == "1", F.sha2("sha256", 256)).when(h != "3", F.col("sha256")).alias("sha256"))
    return AU.reconcile(recorded, live, "doc_id").groupBy("status").agg(F.count(F.lit(1)).alias("items"))


_HOST, _PATH = "lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1))", "regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)"


@query("a08_broken_links", f"""
WITH page AS (
  SELECT page_id, {_HOST} AS host, {_PATH} AS path, substr(md5(CAST(page_id AS VARCHAR)), 1, 1) AS h, html FROM pages
), link AS (
  SELECT page_id, host, path, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM page
  UNION ALL SELECT page_id, host, path, path FROM page WHERE h = '0'
  UNION ALL SELECT page_id, host, path, string_split(path, '/')[-1] FROM page WHERE h = '1'
  UNION ALL SELECT page_id, host, path, 'no-such-page.html' FROM page WHERE h = '2'
  UNION ALL SELECT page_id, host, path, 'http://' || host || path || '?again=1' FROM page WHERE h = '3'
), plain AS (
  SELECT page_id, target, host, path, regexp_extract(target, '^([^?#]*)', 1) AS p FROM link
  WHERE target NOT LIKE 'mailto:%' AND target NOT LIKE 'javascript:%' AND target NOT LIKE 'tel:%' AND target NOT LIKE 'data:%'
), resolved AS (
  SELECT page_id, target, CASE WHEN p LIKE 'http%://%' THEN lower(regexp_extract(p, '^https?://([^/]+)', 1)) ELSE host END AS host,
         CASE WHEN p LIKE 'http%://%' THEN regexp_extract(p, '^https?://[^/]+(.*)$', 1) WHEN p LIKE '/%' THEN p
              ELSE regexp_extract(path, '^(.*/)', 1) || p END AS path
  FROM plain WHERE p <> ''
)
SELECT page_id, target, starts_with(target, '/') AS is_absolute FROM resolved r
WHERE host IN (SELECT host FROM page)
  AND NOT EXISTS (SELECT 1 FROM page k WHERE k.host = r.host AND k.path = r.path)""")
def a08_broken_links(spark, sf_dir):
    """Broken links to the table's own hosts; pages chosen by md5 get links to themselves (from the root, from
    their folder, with host and query) and to a page that does not exist."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    h = F.substring(F.md5(F.col("page_id").cast("string")), 1, 1)
    own = (F.when(h == "0", AU.url_path()).when(h == "1", F.element_at(F.split(AU.url_path(), "/"), -1)).when(h == "2", "no-such-page.html")
            .when(h == "3", F.concat(F.lit("http://"), AU.url_host(), AU.url_path(), F.lit("?again=1"))))
    return AU.broken_links(pages.withColumn("html", F.concat("html", F.coalesce(F.concat(F.lit('<a href="'), own, F.lit('">')), F.lit("")))))


# turns chosen by the md5 of their key are left out (a gap) or moved to the next number (a gap and a repeated turn)
@query("a09_sequence_check", """
SELECT conv_id, count(*) AS items,
       CAST(sum(CASE WHEN turn <> expected THEN 1 ELSE 0 END) AS BIGINT) AS violations
FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS expected
      FROM (SELECT conv_id, CASE WHEN digit = '1' THEN turn + 1 ELSE turn END AS turn
            FROM (SELECT conv_id, turn, substr(md5(conv_id || '/' || turn), 1, 1) AS digit FROM conversations) k WHERE digit <> '0') m) c
GROUP BY conv_id""")
def a09_sequence_check(spark, sf_dir):
    """Turn numbers of every conversation must run 0..n-1."""
    digit = F.substring(F.md5(F.concat_ws("/", "conv_id", "turn")), 1, 1)
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn"]).withColumn("digit", digit).where(F.col("digit") != "0")
    return AU.sequence_check(turns.withColumn("turn", F.when(F.col("digit") == "1", F.col("turn") + 1).otherwise(F.col("turn"))), "conv_id", "turn")
