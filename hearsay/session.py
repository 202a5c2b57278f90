"""Session helpers: time zone, shared scratch folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import functools
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Frames with a proven row bound up to this size are broadcast, larger ones are not.
BROADCAST_ROWS = 100_000
# Codec of stored and staged tables: texts take two thirds of what they take by default.
COMPRESSION = "zstd"


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@functools.cache
def own_folder() -> str:
    """Scratch of a single-machine session; gone when the process ends."""
    folder = tempfile.mkdtemp(prefix="hearsay-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path that every executor can reach.

    The cluster names the parent in `spark.checkpoint.dir`; only where that is
    unset (single-machine tests) is a local temporary folder taken.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        parent = own_folder()
    return f"{parent.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Give `write(frame, name)`: the frame as a table in the shared folder. All are deleted at the end."""
    made: list[str] = []

    def write(frame: DataFrame, name: str) -> DataFrame:
        made.append(shared_folder(spark, name))
        frame.write.option("compression", COMPRESSION).parquet(made[-1])
        return spark.read.parquet(made[-1])

    try:
        yield write
    finally:
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed: Spark does so when the driver's objects are collected.

    A long job that never fills the driver's memory would keep them all. The second
    collection takes what the last query left.
    """
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Split an input of few files over all cores before costly per-row work.

    A large input has more splits than the cluster has cores and stays as it is.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, key)


def broadcast_if(frame: DataFrame, row_bound: int | None) -> DataFrame:
    """Hint a broadcast only when the caller can prove a small row bound."""
    if row_bound is not None and row_bound <= BROADCAST_ROWS:
        return F.broadcast(frame)
    return frame


def local_frame(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A few driver-side parameters as a frame with known size."""
    frame = spark.createDataFrame(pa.table(columns))
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return frame.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def settled(frame: DataFrame, *columns: Column) -> DataFrame:
    """Select costly columns so that a later filter does not compute them again.

    Catalyst moves a filter below a projection by copying the expressions into
    it; it leaves a filter on the output of a generator where it is.
    """
    return frame.select(F.inline(F.array(F.struct(*columns))))
