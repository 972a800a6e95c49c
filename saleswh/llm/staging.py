"""Written intermediate tables between the large steps of an operator."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from saleswh.storage import stage


#: Asks Spark to delete the shuffle files of a statement when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def collect_garbage(spark: SparkSession) -> None:
    """Collect the driver's garbage, Python's and the JVM's, so that its heap shrinks before the next large step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder, go on from the written table and let go of what made it.

    The shuffle files of one large step need not share the disk with those of the next: Spark drops them once the table
    is written. The driver's garbage is collected as well.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        written = stage(df, label)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    collect_garbage(df.sparkSession)
    return written
