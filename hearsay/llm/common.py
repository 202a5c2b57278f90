"""Shared pieces: scratch tables, ASCII case folding, small-table joins, row identity."""

from __future__ import annotations

import atexit
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.session import BROADCAST_ROWS, shared_folder

# The white space that separates words, as a regex class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Tables that results outside any `scratch` block read; deleted when the process ends.
_left: list[str] = []
_owner: ContextVar[list[str]] = ContextVar("scratch", default=_left)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end, and no others: write the result inside."""
    made: list[str] = []
    token = _owner.set(made)
    try:
        yield
    finally:
        _owner.reset(token)
        for folder in made:
            delete_folder(spark, folder)


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage: later steps read files, so a lost executor costs its own
    tasks only and nothing above is computed again.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark, "llm-" + name)
    owner = _owner.get()
    owner.append(folder)
    frame.write.parquet(folder)
    staged = spark.read.schema(frame.schema).parquet(folder)
    staged._scratch_folder, staged._scratch_owner = folder, owner
    return staged


def stage_by(frame: DataFrame, name: str, key: str, buckets: int, compression: str = "snappy") -> DataFrame:
    """As `stage`, in buckets of a key: tables of one key and number of buckets are joined without a shuffle.

    Rows of megabytes had better not be compressed by snappy, which keeps whole pages in memory outside the heap.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark, "llm-" + name)
    owner = _owner.get()
    owner.append(folder)
    # Only a table can say that it is bucketed; its entry goes as soon as the files are known by it.
    table = "hearsay_" + folder.rsplit("-", 1)[-1]
    frame.write.format("parquet").bucketBy(buckets, key).sortBy(key).options(path=folder, compression=compression).saveAsTable(table)
    staged = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    staged._scratch_folder, staged._scratch_owner = folder, owner
    return staged


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*staged: DataFrame) -> None:
    """Delete scratch tables that no later step reads, and let go of finished shuffles.

    A long job that never fills the driver's memory would keep them all.
    """
    for frame in staged:
        frame._scratch_owner.remove(frame._scratch_folder)
        delete_folder(frame.sparkSession, frame._scratch_folder)
    let_go(staged[0])


def let_go(frame: DataFrame) -> None:
    """Have the files of finished shuffles removed: Spark does so when the driver's objects are collected."""
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()


def leave_to_exit(folder: str) -> None:
    """Have a folder that a returned result reads deleted when the process ends."""
    _left.append(folder)


@atexit.register
def _delete_left() -> None:
    context, jvm = SparkContext._active_spark_context, SparkContext._jvm
    if _left and jvm is not None:
        conf = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
        for folder in _left:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. For pure ASCII the fast built-in does the same."""
    pure = F.octet_length(text) == F.length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but the six white-space characters."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_small(big: DataFrame, small: DataFrame, keys: list[str], salts: int = 32) -> DataFrame:
    """Left join with one row per key; null keys match null keys.

    The small side is counted. Up to BROADCAST_ROWS rows it is broadcast; beyond
    that it is copied once per salt, so a hot key of the big side is dealt over
    that many tasks.
    """
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    else:
        values = F.array(*[F.lit(i) for i in range(salts)])
        small = small.withColumn("__salt", F.explode(values))
        big = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
        keys = [*keys, "__salt"]
    joined = big.join(small, same(big, small, keys), "left")
    extra = [small[c] for c in small.columns if c not in keys]
    return joined.select(*[big[c] for c in big.columns if c != "__salt"], *extra)


def row_key(*columns: str) -> Column:
    """128-bit identity of a row by the columns a decision rests on; equal rows share it."""
    def written(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.md5(F.concat_ws(",", *map(written, columns))))


def keep_rows(docs: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of docs whose `row_key(*columns)` is in kept.__key (one row per key)."""
    marked = docs.withColumn("__key", row_key(*columns))
    return marked.join(kept.select("__key"), "__key", "left_semi").select(*docs.columns)
