"""Stage boundaries: write a DataFrame once to the shared checkpoint folder and read it back.

This cuts lineage (executor loss recomputes from the written table, not from the raw
scans) and lets several queries reuse one materialized panel, like the workflow's own
sidecar files. The folder is ``spark.checkpoint.dir`` (shared storage on a cluster).
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from caseload.session import compilable_methods, ensure_checkpoint_dir, release_shuffles

_MEMO: dict[tuple, DataFrame] = {}
_LOCK = threading.RLock()  # queries may be driven from several threads; build each stage once


def settings_key(*settings) -> str:
    """Short digest of the settings a stage depends on, for its name."""
    return hashlib.sha1(repr(settings).encode()).hexdigest()[:10]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input folder's listing, through the file system that Spark reads it with."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(path)]
    return hashlib.sha1("|".join(sorted(files)).encode()).hexdigest()[:12]


def materialized(spark: SparkSession, name: str, sf_dir: str, build, partition_by=None) -> DataFrame:
    """Build ``name`` for ``sf_dir`` once per application, store it as parquet, return a scan."""
    app = spark.sparkContext.applicationId
    compilable_methods(spark)
    key = (app, name, sf_dir, _fingerprint(spark, sf_dir))
    with _LOCK:
        hit = _MEMO.get(key)
        if hit is not None:
            return hit
        return _build(spark, name, sf_dir, build, partition_by, key, app)


def _build(spark, name, sf_dir, build, partition_by, key, app) -> DataFrame:
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/caseload-stages/{app}/{name}-{key[-1]}"
    writer = build().write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    del writer
    release_shuffles(spark)
    df = spark.read.parquet(path)
    _MEMO[key] = df
    return df


def remembered(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """A cheap plan over written tables, made once per application and not written."""
    key = (spark.sparkContext.applicationId, name, sf_dir, _fingerprint(spark, sf_dir))
    with _LOCK:
        if key not in _MEMO:
            _MEMO[key] = build()
        return _MEMO[key]


def stage_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A fresh path in the shared stage folder for an explicit sink."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/caseload-sinks/{spark.sparkContext.applicationId}/{name}-{_fingerprint(spark, sf_dir)}"
