"""Staged tables: intermediate results written once to shared storage and read back.

A staged table cuts lineage, so it is read by several consumers without running its
plan again, and it survives the loss of executors because it lives in the folder all nodes
share. That folder is the session's ``spark.checkpoint.dir``; each application has one folder
in it. `release` deletes it; it can also be deleted when the application has ended.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

LOCAL_ROWS = 5_000
PAGE_ROWS = 1_000


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables; a local session without a setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all nodes")
    root = tempfile.mkdtemp(prefix="nextpick-")
    spark.sparkContext.setCheckpointDir(root)
    return stage_root(spark)


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Fix a fitted table: a local relation if it has at most LOCAL_ROWS rows, else staged."""
    table = frame.limit(LOCAL_ROWS + 1).toArrow()
    if table.num_rows <= LOCAL_ROWS:
        return frame.sparkSession.createDataFrame(table, schema=frame.schema)
    return stage(frame, name)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the application's folder in the shared folder."""
    return f"{stage_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write `frame` as parquet under the shared folder and return a scan of it."""
    spark = frame.sparkSession
    path = stage_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stage_bucketed(frame: DataFrame, name: str, key: str) -> DataFrame:
    """Stage `frame` in buckets of `key`, sorted by it, and return a scan that knows this layout.

    Aggregations and windows by `key`, and joins of such tables on it, need no shuffle. A filter on a
    value of `key` reads only the pages that can hold the value. A key's rows share a
    bucket, so make them few (distinct, say) before. There are as many buckets as shuffle partitions.
    """
    spark = frame.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"nextpick_{uuid4().hex}"
    (frame.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", stage_path(spark, name)).option("parquet.page.row.count.limit", str(PAGE_ROWS)).saveAsTable(table))
    return spark.table(table)


def release(spark: SparkSession) -> None:
    """Delete everything that this application has staged; frames that read it can't be used any more."""
    for table in spark.catalog.listTables():
        if table.name.startswith("nextpick_") and not table.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{stage_root(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
