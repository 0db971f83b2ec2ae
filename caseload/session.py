"""SparkSession construction and the shared stage folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "caseload") -> SparkSession:
    """Local/test session. On a cluster use the session the platform provides."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", os.environ.get("CASELOAD_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; only set a private one when the session has none.

    On a cluster the platform names a shared folder there; we never replace it.
    Local runs and tests get a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current:
        if not sc_dir.isDefined():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir.isDefined():
        current = sc_dir.get()
    elif not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    else:
        current = tempfile.mkdtemp(prefix="caseload-ckpt-", dir=os.environ.get("CASELOAD_SCRATCH", "/tmp"))
        spark.sparkContext.setCheckpointDir(current)
    spark.conf.set("spark.checkpoint.dir", current)
    return current


#: Bytes of a generated method above which the JVM does not compile it but interprets it, many times slower.
JIT_BYTES = 8000


def compilable_methods(spark: SparkSession) -> None:
    """Let Spark generate code by operator, in small methods, where one method for a whole stage would be above ``JIT_BYTES``."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) > JIT_BYTES:
        spark.conf.set(key, str(JIT_BYTES))


def release_shuffles(spark: SparkSession) -> None:
    """Ask for a collection of the driver's garbage: Spark deletes the shuffle files of a plan once the plan is collected, which may
    be long after its table was written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_table(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: later plans see its size and never compute it again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/caseload-scratch/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
