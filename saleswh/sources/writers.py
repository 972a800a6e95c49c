"""Sinks: Parquet datasets, tables, reports, versioned datasets, views, cached frames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.operators.maintain import replicate
from saleswh.storage import file_system


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet unless a complete dataset is there already; returns the dataset at the path.

    A dataset counts as complete with its success marker. A folder that a crashed job left without one is written anew; one
    that holds anything but Spark's part files is an error, so nothing foreign is ever replaced.
    """
    spark = df.sparkSession
    fs, folder = file_system(spark, path)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if not fs.exists(marker):
        if fs.exists(folder):
            names = [s.getPath().getName() for s in fs.listStatus(folder)]
            if strange := [n for n in names if not n.startswith(("part-", "_temporary", ".part-", "._")) and "=" not in n]:
                raise ValueError(f"{path} has no success marker and holds {strange[:3]}")
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scaled_path(base: str, scale: int) -> str:
    return f"{base.rstrip('/')}/scaled_data_{scale}.parquet"


def prescale(df: DataFrame, base: str, scales: Sequence[int]) -> dict[int, str]:
    """Write the frame replicated to each scale, leaving scales that exist already as they are."""
    for scale in scales:
        write_once(replicate(df, scale), scaled_path(base, scale))
    return {scale: scaled_path(base, scale) for scale in scales}


def append_table(df: DataFrame, name: str, cols: Sequence[str] | None = None, path: str | None = None) -> None:
    """Append the chosen columns to a table, by column name; other table columns become null, unknown ones are an error.

    ``path`` places the table's files when the table does not exist yet.
    """
    spark = df.sparkSession
    out = df.select(*cols) if cols else df
    if spark.catalog.tableExists(name):
        empty = spark.table(name).limit(0)
        if unknown := [c for c in out.columns if c not in empty.columns]:
            raise ValueError(f"columns that {name} does not have: {unknown}")
        out = empty.unionByName(out, allowMissingColumns=True).select(*empty.columns)
        out.write.mode("append").insertInto(name)
        return
    writer = out.write.mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_jdbc(df: DataFrame, url: str, name: str, cols: Sequence[str] | None = None, **connection: str) -> None:
    """Append to a database table in batches, one connection per partition."""
    out = df.select(*cols) if cols else df
    out.write.format("jdbc").mode("append").options(url=url, dbtable=name, **connection).save()


def ctas(name: str, df: DataFrame, path: str | None = None) -> DataFrame:
    """Create (or replace) a table from a query."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file with a header, in the frame's order. For report-sized results only: one task writes it.

    The rows are made in parallel and sent to that task with their place, so it does none of the work before.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    one = placed.repartition(1).sortWithinPartitions("_place").drop("_place")
    one.write.mode("overwrite").option("header", True).csv(path)


def publish_version(df: DataFrame, base: str, write: Callable[[DataFrame, str], None] | None = None) -> str:
    """Write a new version directory under ``base`` and return its path. ``write`` (df, path) replaces plain Parquet.

    The dataset being read is never overwritten; a version counts once its
    success marker is there, so a failed job leaves the previous version valid.
    """
    spark = df.sparkSession
    last = _versions(spark, base)
    number = int(last[-1].rsplit("/v", 1)[1].split("-")[0]) + 1 if last else 1
    path = f"{base.rstrip('/')}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    if write:
        write(df, path)
    else:
        df.write.parquet(path)
    return path


def latest_path(spark: SparkSession, base: str) -> str | None:
    """The path of the newest complete version under ``base``."""
    found = _versions(spark, base)
    return found[-1] if found else None


def read_latest(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest complete version under ``base``; None when there is none."""
    found = latest_path(spark, base)
    return spark.read.parquet(found) if found else None


def _versions(spark: SparkSession, base: str) -> list[str]:
    """Complete versions under ``base``, oldest first. Touches directory names only."""
    fs, path = file_system(spark, base)
    if not fs.exists(path):
        return []
    marker = spark._jvm.org.apache.hadoop.fs.Path
    dirs = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("v")]
    done = [p.toString() for p in dirs if fs.exists(marker(p, "_SUCCESS"))]
    return sorted(done, key=lambda p: p.rsplit("/", 1)[1])


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def prepare(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cache and materialise a frame that several metrics will read.

    Repartitions only when asked: aggregations need no even split beforehand.
    """
    out = df.repartition(partitions) if partitions else df
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out
