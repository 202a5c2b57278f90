"""Loading a sentiment lexicon: tab-separated `token, mean valence, ...`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.functions.lookup import MAX_ENTRIES


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """`(token, valence)` of the first two columns; lines that do not parse are left out."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("c"))
    pairs = lines.select(
        F.lower(F.get("c", F.lit(0))).alias("token"),
        F.trim(F.get("c", F.lit(1))).try_cast("double").alias("valence"),
    )
    return pairs.filter("token <> '' and valence is not null")


def lexicon_pairs(lexicon: DataFrame) -> dict[str, float]:
    """The lexicon as scoring parameter; its size is checked before it is taken."""
    rows = lexicon.groupBy("token").agg(F.max("valence").alias("valence"))
    rows = rows.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"lexicon exceeds {MAX_ENTRIES} tokens")
    return {row["token"]: row["valence"] for row in rows}
