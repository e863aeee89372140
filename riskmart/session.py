"""Session settings that the jobs rely on for speed; results do not depend on them.

The number of shuffle partitions is left to the cluster's configuration: aggregates are partial first and move little,
adaptive execution merges what is small and splits what is skewed.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings that may change in a running session.

    Rows of 50 columns make whole-stage methods longer than 8000 bytes, which the JVM never compiles. Operators on wide
    rows, and any other with such a method, therefore run one by one with small compiled methods, about four times
    faster here. Narrow operators keep whole-stage code.
    """
    spark.conf.set("spark.sql.codegen.maxFields", "32")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # A table split in two folders is written with two open files per task instead of sorting the wide rows first;
    # tasks that meet more folders go on to sort.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Numbers that do not fit are an error, never a silent NULL, and dates do not depend on the host.
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def create(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """A configured session; without `master` the cluster's own settings apply."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for name, value in options.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configured(spark: SparkSession) -> SparkSession:
    """A session of the same application with the settings above; the given one keeps its own."""
    return configure(SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession()))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it. A folder of this machine only where no cluster is."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors can reach")
    return os.path.join(tempfile.gettempdir(), "riskmart")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that is read several times, and read it back.

    The stored table cuts the lineage, survives lost executors, keeps column pruning and has a size that Spark knows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/riskmart/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
