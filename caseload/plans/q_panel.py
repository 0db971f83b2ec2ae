"""Registered queries: panel scans, cadence features (SRC1, K1-K16) and the flagship slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.config import CADENCE_FEATURES, CAPACITIES
from caseload.operators.cadence import TARGETS
from caseload.operators.episodes import episode_table
from caseload.operators.queues import attach_topk_flags
from caseload.plans import inputs as I
from caseload.plans.oracle import with_ctes
from caseload.plans.registry import B, R, query
from caseload.sources.contracts import ENGINEERED_COLUMNS

KEYS = ("customer_public_id", "transaction_month")

# --------------------------------------------------------------------------- SRC1
_ENG_SQL_COLS = ", ".join([
    "customer_public_id", "transaction_month", "first_observed_month", B("order_count"),
    B("active_order_days"), B("distinct_product_count"), R("discount_rate"), R("promo_line_share"),
    R("return_line_rate"), R("top_product_revenue_share")])


@query("src1_engineered_panel", with_ctes(f"SELECT {_ENG_SQL_COLS} FROM facts", "facts"))
def src1_engineered_panel(spark, sf_dir):
    """SRC1 + panel derivation: the ten-column engineered customer-month panel."""
    return I.engineered(spark, sf_dir)


# --------------------------------------------------------------------------- K16 and parts
_DBL = [c for c in CADENCE_FEATURES if c not in (
    "current_has_order", "same_month_last_year_active", "same_month_last_year_available")]
_INT = ["current_has_order", "same_month_last_year_active", "same_month_last_year_available"]


def _cad_sql_cols(cols):
    out = []
    for c in cols:
        if c in _INT or c in ("next_has_order",):
            out.append(B(c))
        elif c in ("customer_public_id", "transaction_month", "target_month", "data_split"):
            out.append(c)
        else:
            out.append(R(c))
    return ", ".join(out)


def _cadence_query(name, cols, doc):
    cols = list(cols)
    sql = with_ctes(f"SELECT {_cad_sql_cols(cols)} FROM cadence", "cadence")

    def build(spark, sf_dir):
        return I.cadence(spark, sf_dir).select(*cols)
    build.__doc__ = doc
    query(name, sql)(build)


_cadence_query("k16_cadence_panel",
               ["customer_public_id", "transaction_month", "target_month", "data_split",
                *CADENCE_FEATURES, *TARGETS],
               "K16: full cadence panel (22 features, 5 targets, split).")
_cadence_query("k01_k02_current_month", [*KEYS, "current_has_order", "current_order_count",
               "current_active_order_days", "current_distinct_product_count", "current_discount_rate",
               "current_promo_line_share", "current_return_line_rate", "current_top_product_share"],
               "K1/K2: activity flag and current-month copies.")
_cadence_query("k03_k05_rolling", [*KEYS, "active_rate_3m", "active_rate_6m", "active_rate_12m",
               "order_count_mean_3m", "order_count_mean_6m", "order_count_mean_12m", "order_count_sd_12m"],
               "K3-K5: rolling row-based means and sample sd.")
_cadence_query("k07_k09_recency", [*KEYS, "months_since_active", "inactive_streak"],
               "K6-K9: months since active (forward fill) and inactive run position.")
_cadence_query("k10_k12_calendar", [*KEYS, "same_month_last_year_available",
               "same_month_last_year_active", "tenure_months_asof", "calendar_month_sin", "calendar_month_cos"],
               "K10-K12: 12-row lag, tenure, calendar phase.")
_cadence_query("k13_k15_targets_split", [*KEYS, "target_month", "data_split", *TARGETS],
               "K13-K15: t+1 targets, consecutive filter, split by target month.")


@query("k15_split_counts", with_ctes(
    "SELECT data_split, count(*) AS rows, count(DISTINCT customer_public_id) AS customers "
    "FROM cadence GROUP BY data_split", "cadence"))
def k15_split_counts(spark, sf_dir):
    """Rows and customers per split."""
    return I.cadence(spark, sf_dir).groupBy("data_split").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_public_id").alias("customers"))


# --------------------------------------------------------------------------- flagship slice
def cadence_gap_flags(spark, sf_dir, capacity: int):
    """Forward feature rows scored by |orders - 12-month mean|, top-K per month."""
    cad = I.cadence(spark, sf_dir).where(F.col("data_split") == "forward")
    scored = cad.select(
        "customer_public_id", "transaction_month",
        F.round(F.abs(F.col("current_order_count") - F.col("order_count_mean_12m")), 9).alias("score"),
        F.when(F.col("current_order_count") >= F.col("order_count_mean_12m"), "above_cadence")
         .otherwise("below_cadence").alias("signal_direction"))
    flagged = attach_topk_flags(scored, "score", [capacity], "gap")
    return flagged.withColumnRenamed(f"gap_top_{capacity}", "flag")


def flagship(spark, sf_dir):
    cap = CAPACITIES[1]
    return episode_table(cadence_gap_flags(spark, sf_dir, cap), "cadence_gap")


_FLAG_SQL = with_ctes(f"""
, sc AS (
  SELECT customer_public_id, transaction_month,
         round(abs(current_order_count - order_count_mean_12m), 9) AS score,
         CASE WHEN current_order_count >= order_count_mean_12m THEN 'above_cadence' ELSE 'below_cadence' END AS signal_direction
  FROM cadence WHERE data_split = 'forward'),
fl AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_month ORDER BY score DESC NULLS LAST, customer_public_id) <= {CAPACITIES[1]} AS flag
  FROM sc),
ep AS (
  SELECT *, sum(CASE WHEN coalesce(gap <> 1, true) OR dchg THEN 1 ELSE 0 END)
              OVER (PARTITION BY customer_public_id ORDER BY transaction_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS episode_number
  FROM (SELECT *, (year(transaction_month)*12+month(transaction_month))
                   - lag(year(transaction_month)*12+month(transaction_month)) OVER (PARTITION BY customer_public_id ORDER BY transaction_month) AS gap,
               signal_direction IS DISTINCT FROM lag(signal_direction) OVER (PARTITION BY customer_public_id ORDER BY transaction_month) AS dchg
        FROM fl WHERE flag) f)
SELECT customer_public_id, {B('episode_number')}, min(transaction_month) AS first_month,
       max(transaction_month) AS last_month, count(*) AS months_flagged, {R('max(score)', 'max_score')},
       arg_max(signal_direction, transaction_month) AS signal_direction, 'cadence_gap' AS lens,
       CASE WHEN count(*) = 1 THEN 'new' ELSE 'ongoing' END AS episode_status,
       substr(sha256(concat_ws('|', 'cadence_gap', customer_public_id, CAST(CAST(episode_number AS BIGINT) AS VARCHAR))), 1, 16) AS episode_id
FROM ep GROUP BY customer_public_id, episode_number""", "cadence").replace("\n, sc AS", ",\nsc AS", 1)


@query("ea1_cadence_gap_episodes", _FLAG_SQL)
def ea1_cadence_gap_episodes(spark, sf_dir):
    """Flagship: panel -> K16 -> Q1 top-K on |orders - 12m mean| -> episodes E-A1..E-A4."""
    return flagship(spark, sf_dir)
