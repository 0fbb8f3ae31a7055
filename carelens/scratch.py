"""Folders that driver and executors share, for what a job writes in between."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name: below the cluster's shared folder, or the warehouse where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a shared folder and read again: it is computed once, and lost executors don't lose it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
