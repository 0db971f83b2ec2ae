"""Sinks (SNK1-SNK3) and the matching scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

BLINDED_SCHEMA = StructType([
    StructField("case_id", StringType()), StructField("transaction_month", DateType()),
    StructField("hurdle_direction", StringType()), StructField("review_outcome", StringType()),
    StructField("review_effort_minutes", DoubleType()), StructField("reviewer_notes", StringType()),
])


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_blinded_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(BLINDED_SCHEMA).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    # empty CSV cells come back as NULL; the response fields are empty strings by contract
    return df.select("case_id", "transaction_month", "hurdle_direction",
                     F.coalesce("review_outcome", F.lit("")).alias("review_outcome"), "review_effort_minutes",
                     F.coalesce("reviewer_notes", F.lit("")).alias("reviewer_notes"))


def finite_or_null(c):
    """SNK3: non-finite doubles become NULL (the JSON sink forbids NaN/Infinity)."""
    return F.when(F.col(c).isin(float("inf"), float("-inf")) | F.isnan(F.col(c)), None).otherwise(F.col(c))


def write_metrics_json(df: DataFrame, path: str) -> None:
    """SNK3: long metric table as JSON lines with non-finite values as NULL."""
    out = df.select(*[finite_or_null(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
                      for f in df.schema.fields])
    out.coalesce(1).write.mode("overwrite").json(path)
