"""Column contracts of the panels and the check applied to caller-supplied frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType)

KEYS = ("customer_public_id", "transaction_month")

ENGINEERED_COLUMNS = (
    "customer_public_id", "transaction_month", "first_observed_month", "order_count",
    "active_order_days", "distinct_product_count", "discount_rate", "promo_line_share",
    "return_line_rate", "top_product_revenue_share",
)

ENGINEERED_SCHEMA = StructType([
    StructField("customer_public_id", StringType(), False),
    StructField("transaction_month", DateType(), False),
    StructField("first_observed_month", DateType(), True),
    StructField("order_count", LongType(), True),
    StructField("active_order_days", LongType(), True),
    StructField("distinct_product_count", LongType(), True),
    StructField("discount_rate", DoubleType(), True),
    StructField("promo_line_share", DoubleType(), True),
    StructField("return_line_rate", DoubleType(), True),
    StructField("top_product_revenue_share", DoubleType(), True),
])

PEER_INPUT_COLUMNS = (
    "customer_public_id",
    "transaction_month",
    "sparse_history_flag",
    "sparse_peer_group_flag",
    "sparse_company_division_peer_group_flag",
    "company_division_peer_public_id",
    "company_division_peer_customer_count",
    "zero_order_month_flag",
    "net_revenue_vs_history_z",
    "order_count_vs_history_z",
    "quantity_vs_history_z",
    "discount_rate_vs_history_z",
    "return_rate_vs_history_z",
    "category_mix_shift_vs_history_z",
    "net_revenue_vs_peer_z",
    "order_value_vs_company_division_peer_z",
    "net_revenue_vs_peers_resid",
    "order_count_vs_peers_resid",
    "net_revenue_yoy_ratio",
    "order_count_yoy_ratio",
    "baseline_anomaly_score",
)



def require_columns(df: DataFrame, contract, what: str = "Prepared peer input") -> DataFrame:
    """Schema-only check (no job): raise ``ValueError`` naming missing columns, sorted."""
    missing = sorted(set(contract) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: " + ", ".join(missing))
    return df.select(*contract)
