"""Audit jobs (A1-A9) as table scans: token and path-pattern scans, JSON cell scans,
allow/deny inventory filters, duplicate names, content-hash inventories, reconciliation,
broken-link reports and sequence checks. Every job is a projection/filter/aggregate over the
text tables; small fixed lists (tokens, patterns) are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseload.config import (ALLOWED_DIRECTORY_SUFFIXES, EXCLUDED_NAMES, EXCLUDED_SUFFIXES, FORBIDDEN_ARCHIVE_PARTS,
                             FORBIDDEN_ARCHIVE_SUFFIXES, FORBIDDEN_OUTPUT_TOKENS)


def token_findings(texts: DataFrame, tokens=FORBIDDEN_OUTPUT_TOKENS) -> DataFrame:
    """A1: one finding per (source, id, token) where lower(text) contains the token."""
    low = F.lower("text")  # once per text; the fixed token list is filtered per row, no row expansion
    hits = F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.instr(low, t) > 0)
    return texts.select("source", "id", F.explode(hits).alias("token"))


def pattern_findings(texts: DataFrame, patterns) -> DataFrame:
    """A2: one finding per (source, id, pattern index) matching a machine-local path pattern."""
    arr = F.array(*[F.struct(F.lit(i).alias("pattern_id"), F.col("text").rlike(p).alias("hit"))
                    for i, p in enumerate(patterns)])
    return texts.select("source", "id", F.explode(arr).alias("m")).where("m.hit").select(
        "source", "id", F.col("m.pattern_id").cast("bigint").alias("pattern_id"))


def findings_summary(texts: DataFrame, findings: DataFrame, key: str, keys) -> DataFrame:
    """Counts per (source, key) including zero-count combinations."""
    spark = texts.sparkSession
    srcs = texts.groupBy("source").agg(F.count(F.lit(1)).alias("rows_scanned"))
    ks = spark.createDataFrame([(k,) for k in keys], f"{key} {'string' if isinstance(keys[0], str) else 'bigint'}")
    cnt = findings.groupBy("source", key).agg(F.count(F.lit(1)).alias("rows_with_finding"))  # a row has one finding for each key
    return srcs.crossJoin(F.broadcast(ks)).join(cnt, ["source", key], "left").select(
        "source", key, "rows_scanned", F.coalesce("rows_with_finding", F.lit(0)).alias("rows_with_finding"))


def json_cells(events: DataFrame) -> DataFrame:
    """A3: parse the semi-structured ``props`` column (``{"k": n}``) with an explicit schema;
    unparseable rows keep a NULL struct and are counted, never dropped."""
    parsed = events.select("event_type", F.from_json("props", "k BIGINT").alias("p"), "props")
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count("p.k").alias("parsed_rows"),
        F.sum(F.when(F.col("props").isNotNull() & F.col("p.k").isNull(), 1).otherwise(0)).cast("bigint").alias("failed_rows"),
        F.min("p.k").alias("min_k"), F.max("p.k").alias("max_k"), F.sum("p.k").alias("sum_k"))


CELLS = ("struct<cells:array<struct<cell_type:string,source:string,source_lines:array<string>,outputs:array<struct<output_type:string,"
         "ename:string,text:array<string>,data:map<string,string>>>>>>")


def notebooks(turns: DataFrame, tokens) -> DataFrame:
    """conv_id, notebook (JSON text): one cell per turn; sources of assistants are lists of lines, others one
    string. The md5 of a turn adds a saved error (0), an image that holds a token (1), printed text with a
    token (2) or a token in the source (3)."""
    h = F.substring(F.md5(F.concat_ws("|", "conv_id", "turn")), 1, 1)
    token = F.get(F.array(*[F.lit(t) for t in tokens]), F.pmod(F.col("turn"), F.lit(len(tokens))).cast("int"))
    text = F.concat(F.coalesce("text", F.lit("")), F.when(h == "3", F.concat(F.lit("\n"), F.upper(token))).otherwise(""))
    listed = F.col("role") == "assistant"
    none = lambda kind: F.lit(None).cast(kind)
    output = lambda kind, ename, shown, data: F.struct(F.lit(kind).alias("output_type"), ename.alias("ename"), shown.alias("text"), data.alias("data"))
    lines, payload = "array<string>", "map<string,string>"
    outputs = (F.when(h == "0", F.array(output("error", F.lit("ValueError"), none(lines), none(payload))))
                .when(h == "1", F.array(output("display_data", none("string"), none(lines), F.create_map(F.lit("image/png"), token))))
                .when(h == "2", F.array(output("stream", none("string"), F.array(F.lit("out:"), token), none(payload)))))
    cell = F.struct(F.lit("code").alias("cell_type"), F.when(~listed, text).alias("source"), F.when(listed, F.split(text, "\n")).alias("source_lines"), outputs.alias("outputs"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("turn", F.to_json(cell).alias("json")))), lambda x: x["json"])
    return turns.groupBy("conv_id").agg(F.concat(F.lit('{"cells":['), F.array_join(texts, ","), F.lit("]}")).alias("notebook"))


def scan_cells(books: DataFrame, tokens) -> DataFrame:
    """A3: per notebook its cells, cells with a forbidden token in source or text output, saved errors and
    images (whose payloads are not scanned). The JSON is parsed with a fixed schema."""
    cells = books.select("conv_id", F.explode_outer(F.from_json("notebook", CELLS)["cells"]).alias("cell"))
    outputs = F.coalesce(F.col("cell.outputs"), F.array())
    shown = F.flatten(F.transform(outputs, lambda o: F.concat(F.coalesce(o["text"], F.array().cast("array<string>")), F.map_values(F.map_filter(
        F.coalesce(o["data"], F.create_map().cast("map<string,string>")), lambda k, v: ~k.startswith("image/"))))))
    whole = F.lower(F.concat_ws("\n", F.col("cell.source"), F.array_join(F.col("cell.source_lines"), "\n"), F.array_join(shown, "\n")))
    hit = F.exists(F.array(*[F.lit(t) for t in tokens]), lambda t: F.instr(whole, t) > 0)
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return cells.groupBy("conv_id").agg(F.count("cell").alias("cells"), count(hit).alias("token_findings"),
                                        count(F.exists(outputs, lambda o: o["output_type"] == "error")).alias("saved_errors"),
                                        count(F.exists(outputs, lambda o: F.coalesce(F.map_contains_key(o["data"], "image/png"), F.lit(False)))).alias("images_skipped"))


def path_parts(paths: DataFrame, col: str = "path") -> DataFrame:
    p = F.col(col)
    name = F.element_at(F.split(p, "/"), -1)
    suffix = F.regexp_extract(name, r"(\.[^.]+)$", 1)
    return paths.select("*", name.alias("name"), F.lower(suffix).alias("suffix"), F.split(p, "/").alias("parts"))


def inventory_decision(paths: DataFrame, col: str = "path") -> DataFrame:
    """A4: allow/deny by suffix, directory part and name (package allow-list + archive deny-list)."""
    df = path_parts(paths, col)
    in_parts = lambda names: F.exists("parts", lambda x: x.isin(list(names)))
    reason = (F.when(in_parts(FORBIDDEN_ARCHIVE_PARTS), "forbidden_part")
               .when(in_parts(EXCLUDED_NAMES), "excluded_name")
               .when(F.col("name") == ".env", "env_file")
               .when(F.col("suffix").isin(list(FORBIDDEN_ARCHIVE_SUFFIXES)), "forbidden_suffix")
               .when(F.col("suffix").isin(list(EXCLUDED_SUFFIXES)), "excluded_suffix")
               .when(~F.col("suffix").isin(list(ALLOWED_DIRECTORY_SUFFIXES)), "suffix_not_allowed"))
    return df.select(col, "name", "suffix", reason.isNull().alias("allowed"),
                     F.coalesce(reason, F.lit("allowed")).alias("decision"))


def url_path(url_col: str = "url") -> F.Column:
    return F.regexp_extract(F.col(url_col), r"^[a-z]+://[^/?#]+([^?#]*)", 1)


def url_host(url_col: str = "url") -> F.Column:
    return F.lower(F.regexp_extract(F.col(url_col), r"^[a-z]+://([^/?#]+)", 1))


def content_inventory(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per item: available, bytes (UTF-8), SHA-256."""
    return df.select(id_col, F.col(text_col).isNotNull().alias("available"),
                     F.octet_length(text_col).cast("bigint").alias("bytes"), F.sha2(F.col(text_col), 256).alias("sha256"))


def reconcile(manifest: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Full outer join of a recorded inventory (key, bytes, sha256) and the live one. Presence decides
    missing and extra; sizes and hashes are compared where they were recorded."""
    m = manifest.select(key, F.lit(True).alias("recorded"), F.col("bytes").alias("m_bytes"), F.col("sha256").alias("m_sha"))
    lv = live.select(key, F.lit(True).alias("present"), F.col("bytes").alias("l_bytes"), F.col("sha256").alias("l_sha"))
    differs = lambda a, b: F.col(a).isNotNull() & ~F.col(a).eqNullSafe(F.col(b))
    status = (F.when(F.col("present").isNull(), "missing").when(F.col("recorded").isNull(), "extra")
               .when(differs("m_bytes", "l_bytes"), "stale_size").when(differs("m_sha", "l_sha"), "stale_hash").otherwise("ok"))
    return m.join(lv, key, "full").select(key, status.alias("status"))


def broken_links(pages: DataFrame) -> DataFrame:
    """Links that lead to a host of the table but to none of its pages (left anti join on host and path).

    Targets resolve as a browser does: host and scheme given, host given, from the root, or from the page's
    folder, with dot segments folded; query and fragment do not count. Anchors, queries of the same page,
    other schemes and hosts outside the table are left out."""
    links = pages.select("page_id", url_host().alias("page_host"), url_path().alias("page_path"),
                         F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("target"))
    plain = F.regexp_extract("target", r"^([^?#]*)", 1)
    links = links.withColumn("plain", plain).where((F.col("plain") != "") & ~F.col("target").rlike(r"^(?!https?:)[A-Za-z][A-Za-z0-9+.-]*:"))
    outside = F.col("plain").rlike(r"^(https?:)?//")
    host = F.when(outside, F.lower(F.regexp_extract("plain", r"^(?:https?:)?//([^/]+)", 1))).otherwise(F.col("page_host"))
    folder = F.regexp_extract("page_path", r"^(.*/)", 1)
    path = (F.when(outside, F.regexp_extract("plain", r"^(?:https?:)?//[^/]+(.*)$", 1))
             .when(F.col("plain").startswith("/"), F.col("plain")).otherwise(F.concat(folder, F.col("plain"))))
    known = pages.select(url_host().alias("host"), _folded(url_path()).alias("path")).distinct()
    there = links.select("page_id", "target", host.alias("host"), _folded(path).alias("path")).join(known.select("host").distinct(), "host", "left_semi")
    return there.join(known, ["host", "path"], "left_anti").select("page_id", "target", F.col("target").startswith("/").alias("is_absolute"))


def _folded(path: F.Column) -> F.Column:
    """A path without . and .. segments; a last empty segment stays (it names a folder)."""
    none = F.array().cast("array<string>")
    parts = F.aggregate(F.split(F.regexp_replace(path, "^/", ""), "/"), none, lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def sequence_check(df: DataFrame, group: str, seq: str, start: int = 0) -> DataFrame:
    """Per group, positions must be start..start+n-1 in order; returns per-group summary."""
    w = Window.partitionBy(group).orderBy(seq)
    pos = F.row_number().over(w) - 1 + start
    d = df.select(group, seq, pos.alias("_expected"))
    return d.groupBy(group).agg(F.count(F.lit(1)).alias("items"),
                                F.sum(F.when(F.col(seq) != F.col("_expected"), 1).otherwise(0)).cast("bigint").alias("violations"))
