"""Cutting lineage with tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_fallback: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="spark-")
    return _local_fallback[app]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table and return a scan of it.

    Used where a result feeds several jobs: it is computed once, survives lost executors, and a
    loop over it keeps a flat plan.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/boardlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
