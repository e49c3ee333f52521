"""Session settings the package relies on, and durable cut points."""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; safe to apply to a session somebody else built.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sensorloom", **conf: str) -> SparkSession:
    """New session. Without `master` the cluster's own launcher decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
