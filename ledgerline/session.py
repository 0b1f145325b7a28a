"""Spark session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every report relies on. AQE re-plans joins from real shuffle
# sizes (broadcast only below the threshold), coalesces small partitions and
# splits skewed ones, so no report hand-picks a physical strategy.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}

# Sizing for a large cluster: many initial shuffle partitions that AQE
# coalesces toward the advisory size, scan splits that fit a task's memory.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # A join partition more than 5x the median and above 512 MB is split
    # (a party or document holding a large share of the rows), even when the
    # split needs an extra shuffle.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline") -> SparkSession:
    """Session for tests and the bench on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LEDGERLINE_DRIVER_MEMORY", "4g")
    conf["spark.ui.showConsoleProgress"] = "false"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(app: str = "ledgerline") -> SparkSession:
    """Session on a cluster; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**BASE_CONF, **CLUSTER_CONF}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Landed tables and lineage cuts go there. Only in a local session, where
    every task sees this machine's disk, is a private folder created when
    nothing is set; on a cluster a missing setting is an error.
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        path = path or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-")
        if sc is not None:
            sc.setCheckpointDir(path)
        else:
            spark.conf.set("spark.checkpoint.dir", path)
    return path


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a location; the driver's JVM lists
    and looks up folders through it."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def read_if_there(spark: SparkSession, path: str, schema: str):
    """A Parquet table that may not have been written yet: empty then."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
