"""Session construction and the shared folder for materialised tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "arrlens",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. On a cluster, build the session
    with the cluster's own settings instead; nothing here is required."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Only when the session leaves it unset *and runs in local mode* (tests,
    the bench) is a fresh scratch folder created and registered. On a
    cluster an unset folder is an error: a driver-local folder would not be
    shared by the executors, so the checkpoints would not survive."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    sc = spark.sparkContext
    ck = sc.getCheckpointDir()
    if ck:
        return ck
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(for example on HDFS or object storage)")
    local = tempfile.mkdtemp(prefix="arrlens-ck-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for a materialised table, of
    this application and call alone."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder."""
    p, q = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).rename(p, q):
        raise OSError(f"{source} could not be renamed to {target}")


def path_version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and time of change of a file or folder: differs once it is rewritten."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()
