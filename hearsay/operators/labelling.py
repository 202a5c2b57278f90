"""Labelling rows: a narrow step, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.labels import classify
from hearsay.operators.upsert import unlabelled
from hearsay.settings import RunSettings


def classifiable_text(title: Column, text: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), text, F.lit(""))


def label_records(rows: DataFrame, settings: RunSettings) -> DataFrame:
    """All columns of `rows` and the four label columns."""
    label = classify(classifiable_text(F.col("title"), F.col("text")), settings)
    names = {
        "sentiment": "sentiment", "sentiment_score": "score",
        "category": "category", "matched_term": "matched_term",
    }
    return rows.withColumn("_label", label).select(
        *rows.columns, *[F.col("_label")[part].alias(name) for name, part in names.items()]
    )


def label_rows(rows: DataFrame, settings: RunSettings) -> DataFrame:
    """`(id, title, text)` to `(id, sentiment, sentiment_score, category, matched_term)`."""
    return label_records(rows.select("id", "title", "text"), settings).drop("title", "text")


def label_pending(mentions: DataFrame, settings: RunSettings) -> DataFrame:
    """Labels for the rows that still miss one; none on a second run."""
    return label_rows(unlabelled(mentions), settings)
