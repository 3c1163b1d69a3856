"""Tables that a plan writes on its way, in a folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df and reads it back: what it is made of is read once, however often it is used, and lost executors cost no more than their tasks."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
