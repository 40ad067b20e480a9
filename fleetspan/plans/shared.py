"""Shared storage for written tables, checkpoints and model artefacts."""

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Where the setting is absent a local session uses a folder of its warehouse;
    a cluster job must name one that all executors can reach.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder is None:
        folder = spark.sparkContext.getConf().get(_SETTING)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to shared storage and read it back.

    For results that several later steps scan: the written table spares them
    the plan behind it and survives the loss of an executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
