"""Session settings and the shared working folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library wants.  Sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("recueil")
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        **extra,
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one the cluster names.

    ``spark.checkpoint.dir`` is read from the session and required on a cluster.  In
    local mode, where all tasks run on one machine, a folder of the warehouse does.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_recueil"
    stamp = spark.sql("SELECT uuid() AS u").first()["u"]
    return f"{base.rstrip('/')}/{name}-{stamp}"


def settled(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder.

    For results that are expensive or must not change when a task runs again.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
    return df.checkpoint()
