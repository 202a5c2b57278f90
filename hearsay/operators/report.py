"""Report aggregates over the mentions table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearsay.functions.text import truncate
from hearsay.settings import LABEL_CHARS, TOP_ITEMS_PER_TOPIC

# Spark drops all but the first k rows of a group before the shuffle only up to
# this k (spark.sql.optimizer.windowGroupLimitThreshold); larger k is salted.
_GROUP_LIMIT = 1000
_SALTS = 64


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, halves to even; 0 of nothing is 0."""
    return F.bround(part * 100.0 / F.greatest(whole, F.lit(1)), 0).cast("bigint")


def sentiment_by_topic(mentions: DataFrame) -> DataFrame:
    """Counts per bucket and mean score per topic, best mean first."""
    counts = [F.count_if(F.col("sentiment") == s).alias(s) for s in ("positive", "neutral", "negative")]
    grouped = mentions.groupBy("topic").agg(
        F.count(F.lit(1)).alias("total"), *counts,
        F.round(F.avg("sentiment_score"), 3).alias("mean_score"),
    )
    return grouped.orderBy(F.col("mean_score").desc_nulls_last(), "topic")


def sentiment_share(by_topic: DataFrame) -> DataFrame:
    """Share of positive and negative rows per topic."""
    return by_topic.select(
        "topic",
        percent(F.col("positive"), F.col("total")).alias("positive_pct"),
        percent(F.col("negative"), F.col("total")).alias("negative_pct"),
    )


def category_distribution(mentions: DataFrame) -> DataFrame:
    """Rows and share per category; unlabelled rows form a group of their own."""
    counts = mentions.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    # One row per category is left here, so the window without keys is tiny.
    total = F.sum("n").over(Window.partitionBy())
    shares = counts.withColumn("share_pct", percent(F.col("n"), total))
    return shares.orderBy(F.col("n").desc(), F.col("category").asc_nulls_last())


def headline_counts(mentions: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: total, topics, quarantined, unlabelled."""
    by_topic = mentions.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("sentiment").isNull() | F.col("category").isNull()).alias("open"),
    )
    stored = by_topic.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("topic").alias("topics"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("unlabelled"),
        F.lit(0).cast("bigint").alias("quarantined"),
    )
    zero = F.lit(0).cast("bigint")
    rejected = quarantine.agg(F.count(F.lit(1)).alias("quarantined")).select(
        zero.alias("total"), zero.alias("topics"), zero.alias("unlabelled"), "quarantined"
    )
    both = stored.unionByName(rejected)
    return both.agg(*[F.sum(c).alias(c) for c in ("total", "topics", "quarantined", "unlabelled")])


def best_first() -> list[Column]:
    """Order of a topic's items: most points, then newest, then by id."""
    return [F.coalesce("points", F.lit(0)).desc(), F.col("created_at").desc(), F.col("id")]


def top_items_per_topic(mentions: DataFrame, k: int = TOP_ITEMS_PER_TOPIC) -> DataFrame:
    """The k items with most points per topic, newer first among equals."""
    title = F.nullif(F.col("title"), F.lit(""))
    items = mentions.select(
        "topic", "id", "created_at", "points", "sentiment", "category", "url",
        truncate(F.coalesce(title, F.col("text")), LABEL_CHARS).alias("label"),
    )
    best = best_first()
    if k > _GROUP_LIMIT:
        # A topic's k best are among the k best of each of its salted parts.
        salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS))
        part = Window.partitionBy("topic", salt).orderBy(*best)
        items = items.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(*best)))
    return ranked.filter(F.col("rank") <= k).select(
        "topic", "rank", "id", "label", "sentiment", "category",
        F.coalesce(F.col("points").cast("string"), F.lit("-")).alias("points"), "url",
    )


def distinct_topics(mentions: DataFrame) -> DataFrame:
    return mentions.select("topic").distinct().orderBy("topic")


def all_mentions(mentions: DataFrame) -> DataFrame:
    """Every column in store order."""
    return mentions.orderBy("topic", F.col("created_at").desc(), "id")
