"""Deterministic dirty variants of the scored panel, for the cleaning operators.

Every defect is chosen by one hex digit of a single md5 over the row key, so the same rows are
dirty in every engine: NULL customer keys, unparseable month text, duplicate keys with a later
ingest sequence, NULL flags, numbers as text including 'NaN' and 'n/a'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.operators.clean import SPARSE_FLAGS
from caseload.sources.contracts import PEER_INPUT_COLUMNS

# the 14 numeric columns of the contract, and for each a hex digit that no other defect uses
NUMERIC = ("company_division_peer_customer_count", *PEER_INPUT_COLUMNS[8:])
DIGITS = (4, 5, 6, 7, 9, *range(22, 31))


def dirty_panel(scored: DataFrame) -> DataFrame:
    key = F.md5(F.concat_ws("|", F.col("customer_public_id"), F.date_format("transaction_month", "yyyy-MM-dd")))
    base = scored.select("*", key.alias("_k")).select(
        F.when(F.substring("_k", 1, 1) == "0", None).otherwise(F.col("customer_public_id")).alias("customer_public_id"),
        F.when(F.substring("_k", 2, 1) == "1", F.lit("bad-month")).otherwise(F.date_format("transaction_month", "yyyy-MM-dd"))
         .alias("transaction_month"),
        F.conv(F.substring("_k", 10, 12), 16, 10).cast("bigint").alias("ingest_seq"),
        *[F.when(F.substring("_k", 3, 1) == "2", None).otherwise(F.col(c)).alias(c) for c in SPARSE_FLAGS],
        F.when(F.substring("_k", 3, 1) == "3", None).otherwise(F.col("zero_order_month_flag")).alias("zero_order_month_flag"),
        *[F.when(F.substring("_k", i, 1) == "4", F.lit("NaN")).when(F.substring("_k", i, 1) == "5", F.lit("n/a"))
           .otherwise(F.col(c).cast("string")).alias(c) for i, c in zip(DIGITS, NUMERIC)],
        (F.substring("_k", 8, 1) == "e").alias("_dup"))
    # a duplicate is made beside its row, so the panel is read once
    rows = base.withColumn("_copy", F.explode(F.when(F.col("_dup"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rows.withColumn("ingest_seq", F.col("ingest_seq") + F.col("_copy")).withColumn(
        "order_count_vs_history_z", F.when(F.col("_copy") == 1, F.lit("n/a")).otherwise(F.col("order_count_vs_history_z")))
    return rows.drop("_dup", "_copy")
