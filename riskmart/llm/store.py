"""Intermediate tables in the shared folder, and what Python workers need to find this package."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskmart import session

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PAUSE = 0.5  # seconds


def workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where executors see the same files; elsewhere ship it with --py-files."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
    return spark


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that the cluster names in spark.checkpoint.dir."""
    base = session.shared_folder(spark).rstrip("/")
    return f"{base}/riskmart-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is read several times, and read it back.

    The stored table cuts the lineage, survives lost executors and has a size that Spark knows, so that joins with it
    are broadcast only below the session's threshold. Shuffle files of the finished job are released at once: Spark
    deletes them when the driver's objects for them are collected, which its listeners hold for a moment longer.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    time.sleep(PAUSE)
    spark.sparkContext._jvm.System.gc()
    stored = spark.read.schema(df.schema).parquet(path)
    stored.staged_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a staged table that nothing later reads: what was derived from it must be staged itself."""
    path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(stored.staged_at)
    path.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")
