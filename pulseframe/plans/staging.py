"""Cut lineage by writing an intermediate table to the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only in local mode, a cluster without it is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pulseframe-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: later passes scan only the columns they need and survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
