"""Keyed writes as joins: in-batch dedupe, insert-or-ignore, label write-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearsay.operators.normalise import LABEL_COLUMNS


def last_per_id(records: DataFrame) -> DataFrame:
    """One record per id: the last in (topic order, page, position).

    Spark keeps one row per id on the map side (WindowGroupLimit) before it
    shuffles, so a hot id sends one row per task.
    """
    late_first = Window.partitionBy("id").orderBy(
        F.col("topic_order").desc(), F.col("topic").desc(), F.col("page").desc(), F.col("pos").desc()
    )
    ranked = records.withColumn("_rank", F.row_number().over(late_first))
    return ranked.filter("_rank = 1").drop("_rank", "topic_order", "page", "pos")


def insert_or_ignore(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of a batch, unique on `key`, whose key is not stored yet."""
    return batch.join(stored.select(key), key, "left_anti")


def upsert_counts(batch: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """`(inserted, duplicates)` that offering this batch gives; reads keys only."""
    known = stored.select(key, F.lit(True).alias("_known"))
    return batch.select(key).join(known, key, "left").agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("duplicates"),
    )


def first_per_payload(rejects: DataFrame) -> DataFrame:
    """One reject per payload hash: the first in (topic order, page, position)."""
    early_first = Window.partitionBy("payload_hash").orderBy("topic_order", "topic", "page", "pos")
    ranked = rejects.withColumn("_rank", F.row_number().over(early_first))
    return ranked.filter("_rank = 1").select(
        "payload_hash", "raw_id", "topic", "reason", "payload", "recorded_at"
    )


def apply_labels(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """Overwrite all three label columns of every mention that `labels` names.

    Of several labels for an id the last wins: by `labelled_at` if there is such
    a column, else the greatest, so a mention never becomes two rows.
    """
    label = F.struct(*LABEL_COLUMNS)
    last = F.max_by(label, "labelled_at") if "labelled_at" in labels.columns else F.max(label)
    one = labels.groupBy("id").agg(last.alias("_l"))
    new = one.select(
        "id", F.lit(True).alias("_new"), *[F.col(f"_l.{c}").alias(f"_{c}") for c in LABEL_COLUMNS]
    )
    joined = mentions.join(new, "id", "left")
    picked = [
        F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        if c in LABEL_COLUMNS else F.col(c)
        for c in mentions.columns
    ]
    return joined.select(*picked)


def unlabelled(mentions: DataFrame) -> DataFrame:
    """Rows still missing a label, with what the classifier reads."""
    return mentions.filter("sentiment is null or category is null").select("id", "title", "text")
