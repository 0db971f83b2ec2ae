"""Parquet scans of the driver tables, with NaN -> NULL normalization at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Projected scan. Catalyst prunes ``ReadSchema`` to the selected columns and pushes
    filters applied later into the scan; NaN in floating columns becomes NULL."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is not None:
        df = df.select(*columns)
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)
