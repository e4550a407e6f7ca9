"""Session construction and lineage cutting.

On a cluster the session comes from the launcher; `local_session` exists for
tests and the bench.  `cut_lineage` writes a reliable checkpoint into the
shared folder the cluster names in ``spark.checkpoint.dir``; only when that is
unset in a one-machine session (tests, bench) does it pick a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tidyleads") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDYLEADS_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  Only a one-machine session (master local) may
    leave it unset and gets a scratch folder; any other raises."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="tidyleads-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: a lineage cut whose rows, and
    the partition numbers computed into them, are the same for every later reader."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
