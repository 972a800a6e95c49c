"""Session set-up and the shared folder for intermediate tables.

A few operators number rows in a global order. They write the sorted rows once
to the folder named by ``spark.checkpoint.dir`` and go on from the written
table, so a lost executor can never lead to a second, different split.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[str] = []
_local_dir: str | None = None


def build_session(app: str = "saleswh", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings this package is tuned for.

    Shuffle partitions are not fixed here: adaptive execution starts from
    ``initialPartitionNum`` and merges small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join even when the split costs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data; a temporary one in local mode only."""
    global _local_dir
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="saleswh-")
    return _local_dir


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark)}/saleswh/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write df once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def release(spark: SparkSession) -> None:
    """End of a job: drop cached frames and the tables this process staged."""
    spark.catalog.clearCache()
    while _staged:
        fs, path = file_system(spark, _staged.pop())
        fs.delete(path, True)
