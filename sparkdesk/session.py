"""Session builder for local work and tests; on a cluster the caller brings its own session."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "sparkdesk", cores: int | str = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder the cluster names.

    Without one only a session on a single machine goes on, in a temporary folder; a cluster must name it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "sparkdesk")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage for jobs that use a derived table many times; lost executors read it again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores where a file scan has fewer splits than there are cores.

    A table of many files keeps its splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df
