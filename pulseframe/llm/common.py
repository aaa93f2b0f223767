"""Helpers shared by the text operators: tables, shipping of code, shared storage, distributed sums, empty inputs."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partial sums of one array chunk are added in at most this many groups before the last addition.
SUM_SALTS = 64
#: Bytes of one Arrow batch to a Python worker. Sender and receiver hold each batch more than once, so Spark's own bound
#: of 64 MB takes hundreds of MB of an executor when rows carry long texts. A longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give executors this package through Spark's own file server, once a session's context."""
    context = spark.sparkContext
    if getattr(context, "_pulseframe_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="pulseframe-code-"), "pulseframe_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    context._pulseframe_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is missing on a local master, as in tests, is one made here; a cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not (context.master or "").startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="pulseframe-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_BYTES`` for what is run inside; the session's setting returns afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def _added(rows: pa.Table) -> pa.Table:
    data = rows.column("data")
    total = np.frombuffer(data[0].as_buffer(), dtype=np.float64).copy()
    for k in range(1, len(data)):
        total += np.frombuffer(data[k].as_buffer(), dtype=np.float64)
    return pa.table({"key": pa.array([rows.column("key")[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})


def summed_arrays(partials: DataFrame) -> dict[int, np.ndarray]:
    """Add arrays of float64 (``key`` int, ``salt`` int, ``data`` binary) element by element.

    Two levels of groups keep every group small however many tasks contribute. The result has one array for
    each key: callers use a fixed number of keys of fixed length, so what reaches the driver has a fixed size.
    """
    first = partials.groupBy("key", (F.col("salt") % SUM_SALTS).alias("group")).applyInArrow(
        _added, "key int, data binary"
    )
    total = first.groupBy("key").applyInArrow(_added, "key int, data binary")
    return {r["key"]: np.frombuffer(bytes(r["data"]), dtype=np.float64) for r in total.collect()}


def array_chunks(array: np.ndarray, size: int) -> list[tuple[int, bytes]]:
    flat = np.ascontiguousarray(array, dtype=np.float64).ravel()
    return [(k, flat[i : i + size].tobytes()) for k, i in enumerate(range(0, len(flat), size))]
