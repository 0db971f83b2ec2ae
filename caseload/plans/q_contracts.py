"""Registered queries: contract counts, exact pilot probabilities, gated signal families, nested and named audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import CAPACITIES, FORBIDDEN_OUTPUT_TOKENS, PILOT_TARGETS
from caseload.operators import audit as AU
from caseload.operators import outcomes as OC
from caseload.operators import pilot as PL
from caseload.operators.clean import KEYS
from caseload.plans import inputs as I
from caseload.plans import workflows as W
from caseload.plans.oracle import with_ctes
from caseload.plans.q_ops import ALLOC, MG
from caseload.plans.q_outcomes import _FAM
from caseload.plans.registry import R, query
from caseload.sources.contracts import PEER_INPUT_COLUMNS, require_columns
from caseload.sources.tables import read_table

CAP = CAPACITIES[1]


@query("src3_contract_columns", with_ctes(
    f"SELECT {len(PEER_INPUT_COLUMNS)} AS contract_columns, 1 AS missing_columns_refused, count(*) AS rows FROM scored", "scored"))
def src3_contract_columns(spark, sf_dir):
    """SRC3: the scored panel holds the whole contract; the same panel without a column is refused."""
    panel = I.scored(spark, sf_dir)
    kept = require_columns(panel, PEER_INPUT_COLUMNS)
    try:
        require_columns(panel.drop(PEER_INPUT_COLUMNS[-1]), PEER_INPUT_COLUMNS)
        refused = 0
    except ValueError:
        refused = 1
    return kept.agg(F.lit(len(kept.columns)).alias("contract_columns"), F.lit(refused).alias("missing_columns_refused"), F.count("*").alias("rows"))


@query("c08_panel_grain", with_ctes("""
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT customer_public_id, transaction_month FROM scored) d) AS customer_months,
       count(*) FILTER (WHERE transaction_month IS NULL) AS null_months FROM scored""", "scored"))
def c08_panel_grain(spark, sf_dir):
    """Rows, distinct customer-months and NULL months of the scored panel."""
    per = I.scored(spark, sf_dir).groupBy(*KEYS).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows"), F.count("*").alias("customer_months"),
                   F.sum(F.when(F.col("transaction_month").isNull(), F.col("n")).otherwise(0)).alias("null_months"))


_ORDER = {name: i for i, (name, _) in enumerate(PILOT_TARGETS)}
_MASK_SQL = {
    "agreement_core": "ch AND hu", "channel_only": "ch AND NOT hu", "hurdle_only": "hu AND NOT ch",
    "peer_definition_disagreement": "(ch <> co) OR (ch <> hy)", "background": "NOT (ch OR hu OR co OR hy)",
}
_ORDINAL = "CASE sampling_stratum " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in _ORDER.items()) + f" ELSE {len(_ORDER)} END"


@query("p05_exact_inclusion", with_ctes(f"""
, latest AS (
  SELECT m.customer_public_id, channel_top_{CAP} AS ch, hurdle_top_{CAP} AS hu, company_division_top_{CAP} AS co, hybrid_top_{CAP} AS hy, a.ordinal
  FROM {MG} m LEFT JOIN (SELECT customer_public_id, {_ORDINAL} AS ordinal FROM {ALLOC}) a ON m.customer_public_id = a.customer_public_id
  WHERE transaction_month = (SELECT max(transaction_month) FROM {MG})
), pools AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS sampling_stratum, count(*) FILTER (WHERE ({m}) AND (ordinal IS NULL OR ordinal >= {_ORDER[n]})) AS pool, count(*) FILTER (WHERE ordinal = {_ORDER[n]}) AS drawn FROM latest" for n, m in _MASK_SQL.items() if n in _ORDER)}
  UNION ALL SELECT 'capacity_fill', count(*) FILTER (WHERE ordinal IS NULL OR ordinal >= {len(_ORDER)}), count(*) FILTER (WHERE ordinal = {len(_ORDER)}) FROM latest
)
SELECT sampling_stratum, pool, drawn, {R("CASE WHEN pool > 0 THEN drawn * 1.0 / pool ELSE 0.0 END", "exact_inclusion_probability")} FROM pools""",
    MG, ALLOC).replace("\n\n, latest AS", ",\nlatest AS", 1).replace(")\n, latest AS", "),\nlatest AS", 1))
def p05_exact_inclusion(spark, sf_dir):
    """P5, exact variant: each stratum's pool after the customers of earlier strata are excluded."""
    return PL.exact_inclusion(W.merged_lenses(spark, sf_dir), W.pilot(spark, sf_dir), CAP)


@query("d07_gated_signal_families", with_ctes(f"""
SELECT lane, CAST(families AS BIGINT) AS families, count(*) AS customer_months FROM (
  SELECT customer_public_id, transaction_month, count(DISTINCT family) AS families,
         CASE WHEN count(DISTINCT family) > 1 THEN 'corroborated' ELSE 'discovery' END AS lane
  FROM {MG}, LATERAL (VALUES {', '.join(f"('{f}', {l}_top_{CAP})" for l, f in _FAM.items())}) v(family, flag)
  WHERE flag AND hurdle_eligible AND channel_s2_score IS NOT NULL GROUP BY customer_public_id, transaction_month) x
GROUP BY lane, families""", MG))
def d07_gated_signal_families(spark, sf_dir):
    """D7 behind its quality gate: only rows that both lenses could score."""
    gate = F.col("hurdle_eligible") & F.col("channel_s2_score").isNotNull()
    fam = OC.signal_families(W.merged_lenses(spark, sf_dir), _FAM, CAP, gate=gate)
    return fam.groupBy("lane", F.col("families").cast("bigint").alias("families")).agg(F.count("*").alias("customer_months"))


_TOKENS = FORBIDDEN_OUTPUT_TOKENS


@query("a03_nested_cell_scan", f"""
WITH cell AS (
  SELECT conv_id, text, substr(md5(conv_id || '|' || turn), 1, 1) AS h, {list(_TOKENS)}[turn % {len(_TOKENS)} + 1] AS token FROM conversations
)
SELECT conv_id, count(*) AS cells, count(*) FILTER (WHERE h IN ('2', '3')) AS token_findings,
       count(*) FILTER (WHERE h = '0') AS saved_errors, count(*) FILTER (WHERE h = '1') AS images_skipped
FROM cell GROUP BY conv_id""")
def a03_nested_cell_scan(spark, sf_dir):
    """A3: nested JSON (cells, each with a source of one string or a list, and outputs) scanned for tokens in text
    payloads; image payloads are skipped, saved errors counted. One notebook per conversation, with outputs and
    tokens planted by the md5 of the turn; its cells are the conversation's turns."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return AU.scan_cells(AU.notebooks(turns, _TOKENS), _TOKENS)


@query("a05_duplicate_names", """
SELECT name, count(*) AS copies FROM (SELECT string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/')[-1] AS name FROM pages) p
GROUP BY name HAVING count(*) > 1""")
def a05_duplicate_names(spark, sf_dir):
    """A5: members that share a file name."""
    names = AU.path_parts(read_table(spark, sf_dir, "pages", ["url"]).select(AU.url_path().alias("path"))).select("name")
    return names.groupBy("name").agg(F.count("*").alias("copies")).where("copies > 1")


@query("a06_expected_inventory", """
SELECT e.doc_id, d.doc_id IS NOT NULL AND d.text IS NOT NULL AS available, coalesce(CAST(strlen(d.text) AS BIGINT), 0) AS bytes, sha256(d.text) AS sha256
FROM (SELECT CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) = '2' THEN -1 - doc_id ELSE doc_id END AS doc_id FROM labels) e
LEFT JOIN documents d ON e.doc_id = d.doc_id""")
def a06_expected_inventory(spark, sf_dir):
    """A6 against a list of expected items (the labelled documents, some under ids that do not exist)."""
    h = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    expected = read_table(spark, sf_dir, "labels", ["doc_id"]).select(F.when(h == "2", -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"))
    live = AU.content_inventory(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")
    return expected.join(live, "doc_id", "left").withColumns(
        {"available": F.coalesce("available", F.lit(False)), "bytes": F.coalesce("bytes", F.lit(0).cast("bigint"))})
