"""Registered queries opN_<name> of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm.common import documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    from caseload.llm.shard import shard

    out = shard(documents(spark, sf_dir), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    from caseload.llm.packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from caseload.llm.toxicity import toxicity

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return out.select("doc_id", "held_out", "score", "predicted")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: three-word shingles, similarity 0.9."""
    from caseload.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir), words=3, num=90, den=100)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, scanned once per distinct text, by two scans over one ledger: the second scan
    takes all documents and meets the versions that the first has scanned."""
    from caseload.llm.secrets import scan_secrets, span_text

    docs = documents(spark, sf_dir)
    _, ledger = scan_secrets(docs.where(F.pmod(F.xxhash64("text"), F.lit(2)) == 0))
    found, _ = scan_secrets(docs, ledger)
    spans = found.select("*", span_text().alias("spans"))
    return spans.select("doc_id", *[F.size(f"spans_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and digest of every document after repeated lines are dropped."""
    from caseload.llm.linededup import dedup_lines

    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the hierarchical Pitman-Yor model and the unigram base."""
    from caseload.llm.hpylm import score

    return score(documents(spark, sf_dir).select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where the document holds the item, verbatim or reworded."""
    from caseload.llm.decontam import contaminated

    return contaminated(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count rules and robust outlier verdict of every document."""
    from caseload.llm.quality import quality

    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    from caseload.llm.warc import archive_roundtrip

    out, _ = archive_roundtrip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the contract's damage."""
    from caseload.llm.conversation import contract_damage, repair, repaired_digest

    damaged = contract_damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    report, pieces = repair(damaged)
    return repaired_digest(report, pieces).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, from all vectors."""
    from caseload.llm.hardneg import mine_hard_negatives

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that occur again."""
    from caseload.llm.suffixdedup import dedup_spans

    out = dedup_spans(documents(spark, sf_dir).select("doc_id", "text"), 400)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_best_fit_packing, op3_toxicity, op4_jaccard_join, op5_secrets, op6_line_dedup, op7_lm_scoring, op8_decontamination, op9_quality_rules, op10_warc,
                               op11_conversation_repair, op12_hard_negatives, op13_suffix_dedup)
}

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: ASCII lower case of an expression.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format

OP6_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(line) AS line, generate_subscripts(line, 1) AS nth
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line FROM documents)
), keyed AS (
  SELECT *, {_LOWER(f"trim(line, {_SPACES})")} AS key FROM lines
), losing AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE l.key IS NOT NULL AND l.keeper <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.nth) FILTER (WHERE l.key IS NULL OR l.keeper = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN losing l ON k.key = l.key
GROUP BY k.doc_id
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
_KINDS = [
    ("assign", f"""({_NAMES})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
]
# the n-th match begins after the pieces and matches before it
OP5_SQL = "WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS (\n" + "\nUNION ALL\n".join(
    f"""SELECT doc_id, {i} AS nth, '{kind}' AS kind, start, start + len(m) AS stop FROM (
  SELECT doc_id, unnest(ms) AS m, unnest(gs) AS g,
         unnest(list_transform(range(1, len(ms) + 1), lambda k: list_sum(list_transform(ps[1:k], lambda p: len(p)))::BIGINT
                + coalesce(list_sum(list_transform(ms[1:k - 1], lambda p: len(p))), 0)::BIGINT)) AS start
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs,
               string_split_regex(t, '{pattern}') AS ps FROM texts WHERE regexp_matches(t, '{pattern}'))
) WHERE len(g) >= {least}""" for i, (kind, pattern, group, least) in enumerate(_KINDS)) + """
)
SELECT t.doc_id, """ + ", ".join(f"count(*) FILTER (WHERE kind = '{k[0]}') AS n_{k[0]}" for k in _KINDS) + """,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth), '') AS spans
FROM texts t LEFT JOIN found f ON t.doc_id = f.doc_id
GROUP BY t.doc_id
"""

OP10_SQL = """
WITH sums AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), firsts AS (
  SELECT sha, min(page_id) AS origin FROM sums GROUP BY sha
)
SELECT s.page_id, s.payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(s.sha, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))::BIGINT) & 31))::BIGINT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN f.origin = s.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.origin <> s.page_id THEN f.origin END AS refers_to
FROM sums s JOIN firsts f ON s.sha = f.sha
"""

OP4_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM texts
), classes AS (
  SELECT min(doc_id) AS rep, len(any_value(s)) AS n, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), grams AS (
  SELECT rep, n, unnest(s) AS g FROM classes
), links AS (
  SELECT a.rep AS u, b.rep AS v FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT rep AS u, rep AS root FROM classes
  UNION SELECT e.v, r.root FROM reach r JOIN edges e ON r.u = e.u
), roots AS (
  SELECT u, min(root) AS root FROM reach GROUP BY u
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON len(d.s) > 0 AND list_sort(d.s) = c.s LEFT JOIN roots r ON c.rep = r.u
"""

OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""

#: DuckDB SQL. The others use what SQL has not: fitted models, tokenizers, CRC-32, iterative estimates.
SQL: dict[str, str] = {
    "op4_jaccard_join": OP4_SQL,
    "op5_secrets": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op10_warc": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
}
