"""Folders for intermediate tables that all executors reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The shared folder that the session names; an own one only in a local session, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(shared or "/tmp/promolens-checkpoints")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """The frame, written as Parquet to a new folder in the checkpoint folder and read from there."""
    folder = scratch_folder(df.sparkSession, "stored")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
