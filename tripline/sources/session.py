"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods above 8,000 bytecodes interpreted, 5 to 10 times
    # slower; Spark then splits the stage's code by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A rank filter cuts groups before the shuffle whatever its size.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on; all of them are runtime settings."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in
    spark.checkpoint.dir; a session without the setting uses its warehouse.

    On a cluster a warehouse that lies on the machine's own disk is not shared,
    and is refused: name a shared folder then.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not local and (configured.startswith("file:") or "://" not in configured):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder: {configured} is local")
    return configured.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """A fresh folder for one job, which ``remove`` takes away once the job is done."""
    return f"{shared_dir(spark)}/tripline/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a work folder, in whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application: once an
    application has ended, its folder can go."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tripline/{application}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to a job's work folder, and read it back.

    Cuts the lineage, and unlike a cache survives the loss of executors. Rows
    and file splits are then the same for every later read.
    """
    path = scratch(df.sparkSession, name) if folder is None else f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
