"""Session settings the jobs rely on, and where they may keep intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder that the cluster names.

    Without that setting it lies in the session's warehouse: right for local sessions; on a cluster set the one or the other to a
    folder that all executors reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows of a frame that is used several times, written to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly over the shuffle partitions: for work that costs far more than sending the rows.

    A file of few row groups would be read, and worked on, by one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
