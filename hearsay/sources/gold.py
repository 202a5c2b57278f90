"""The hand-label file: written once as a template, read back when filled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.operators.evaluate import GOLD_COLUMNS, gold_template
from hearsay.settings import SAMPLE_SEED, SAMPLE_SIZE

GOLD_SCHEMA = ", ".join(f"{c} string" for c in GOLD_COLUMNS)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def export_gold_template(
    mentions: DataFrame, path: str, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED
) -> int:
    """Write the template and return its row count.

    An existing file is left untouched, and no rows means no file: both give 0.
    The sample has `size` rows, so one file is enough.
    """
    spark = mentions.sparkSession
    if _exists(spark, path):
        return 0
    rows = gold_template(mentions, size, seed)
    if rows.isEmpty():
        return 0
    rows.coalesce(1).write.csv(path, header=True, emptyValue="", escape='"')
    return read_gold(spark, path).count()


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """All rows but short lines. An empty cell is the empty text: a blank prediction is a wrong one."""
    rows = spark.read.csv(
        path, schema=f"{GOLD_SCHEMA}, _short string", header=True, multiLine=True, escape='"',
        columnNameOfCorruptRecord="_short", enforceSchema=True,
    )
    # Spark refuses to read the flag alone, as a bare count would: the filter looks at the cells too.
    read = F.length(F.concat_ws("", *GOLD_COLUMNS)) >= 0
    return rows.filter(F.col("_short").isNull() & read).drop("_short").fillna("")


def read_filled_gold(spark: SparkSession, path: str) -> DataFrame | None:
    """The label file, or None if there is none."""
    return read_gold(spark, path) if _exists(spark, path) else None
