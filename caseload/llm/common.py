"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.session import ensure_checkpoint_dir

#: The ASCII white space that the contracts name: space and \t \n \x0B \f \r.
SPACES = " \t\n\x0b\f\r"


#: Rows of one batch to or from a Python task. Spark's own bound of 10,000 rows is too much for whole texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session hand at most ``BATCH_ROWS`` rows at once to Python tasks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    small_batches(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it: lineage ends there, and a lost
    executor recomputes from the written table."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stashed tables that no later step reads, through the file system layer of Spark.

    Spark deletes the shuffle files of a plan when the driver collects the plan as garbage, which may be
    long after its table is written; asking for a collection here keeps them from piling up."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stash_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    SparkSession.getActiveSession().sparkContext._jvm.System.gc()


def rereadable(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it only scans, filters and projects files, else a written copy: row numbers and
    partition numbers are then the same whenever it is read."""
    plans, plain = [df._jdf.queryExecution().optimizedPlan()], True
    while plans:
        plan = plans.pop()
        children = plan.children()
        plain &= plan.nodeName().split()[0] in ("Project", "Filter", "LogicalRelation", "Relation", "LocalRelation")
        plans += [children.apply(i) for i in range(children.size())]
    return df if plain else stash(df, name)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small bounded table from driver values, as a literal relation (no Python on executors)."""
    names = [x.split()[0] for x in schema.split(",")]
    types = [x.split()[1] for x in schema.split(",")]
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)
    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) or "(" + ", ".join(["NULL"] * len(names)) + ")"
    cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS v({', '.join(names)})" + ("" if rows else " WHERE false"))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
