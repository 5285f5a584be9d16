"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "kindred") -> SparkSession:
    """A session for tests and the bench; on a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test data, heavy work per byte: keep all cores busy after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "10g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    The cluster names that folder. Where it is unset, a temporary folder takes its place on
    a single machine (master ``local``); a cluster raises, because its executors would
    write to folders that nobody else sees.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[[^-]*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kindred-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df, key: str):
    """Spreads rows by ``key`` when there are fewer input splits than cores.

    Cleaning is bound by the processor, so a small input in one file would keep one core
    busy. Inputs with enough splits are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def through_table(df, name: str):
    """Write ``df`` as Parquet to the scratch folder and read it back.

    Cuts the plan at results used several times; the files survive the loss of
    executors, unlike cached blocks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
