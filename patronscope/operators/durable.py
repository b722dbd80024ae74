"""Storing results in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or one in the warehouse where it is unset.

    A warehouse on the driver's own disk will do for a local session only.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that the whole cluster shares")
    return f"{warehouse.rstrip('/')}/patronscope-work"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/patronscope/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
