"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from guidemill.sources.session import give_back_now_and_then


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local session without one gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="guidemill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder as Parquet and read again, so later steps start from files, not from lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    system, where = _file_system(spark, path)
    system.deleteOnExit(where)  # what isn't removed before goes with the application
    give_back_now_and_then(spark)
    return out


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(df: DataFrame) -> None:
    """Delete what written() made, once nothing reads it any more."""
    system, where = _file_system(df.sparkSession, df.written_path)
    system.delete(where, True)
