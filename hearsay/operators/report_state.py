"""Reports kept up to date by mergeable states, one small set of rows per batch.

A batch adds, per (topic, category, sentiment), how many mentions came and went
and the sum of their scores; a mention whose label changed is taken off its old
cell and put on its new one. It also adds its own k best items per topic: the k
best of all batches are among them, as a mention's points, time and id never
change. Reading a report adds up these rows and looks up the labels of the few
best items; no mention is read again, and no text at all.

Score sums are decimals, so a retraction leaves no residue and the order of
batches does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearsay.functions.text import truncate
from hearsay.operators.report import best_first, percent
from hearsay.settings import LABEL_CHARS, TOP_ITEMS_PER_TOPIC

CELL = ("topic", "category", "sentiment")
COUNTS_SCHEMA = "topic string, category string, sentiment string, n bigint, scored bigint, score_sum decimal(38,12)"
ITEMS_SCHEMA = "topic string, id string, created_at timestamp, points bigint, url string, label string"
# Best items per topic that a batch keeps, and so the most that a report can show.
KEPT_ITEMS = 100


def count_changes(came: DataFrame, went: DataFrame | None = None) -> DataFrame:
    """Counts state of rows `(topic, category, sentiment, sentiment_score)` that came, less those that went."""
    columns = [*CELL, "sentiment_score"]
    rows = came.select(*columns, F.lit(1).alias("sign"))
    if went is not None:
        rows = rows.unionByName(went.select(*columns, F.lit(-1).alias("sign")))
    score = F.col("sentiment_score").cast("decimal(24,12)")
    return _merged(rows.select(
        *CELL, F.col("sign").cast("bigint").alias("n"),
        F.when(score.isNull(), 0).otherwise(F.col("sign")).cast("bigint").alias("scored"),
        F.coalesce(score * F.col("sign"), F.lit(0)).alias("score_sum"),
    ))


def _merged(states: DataFrame) -> DataFrame:
    sums = states.groupBy(*CELL).agg(
        F.sum("n").alias("n"), F.sum("scored").alias("scored"),
        F.sum("score_sum").cast("decimal(38,12)").alias("score_sum"),
    )
    return sums.where("n <> 0 or scored <> 0 or score_sum <> 0")


def merge_counts(states: DataFrame) -> DataFrame:
    """One row per cell that still holds mentions; also what compaction writes."""
    return _merged(states)


def relabelled(before: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(came, went)` for new `labels`, one per id, of mentions `(id, topic)` with the labels they had `before`."""
    new = labels.select("id", *[F.col(c).alias(f"_{c}") for c in ("sentiment", "sentiment_score", "category")])
    both = before.join(new, "id")
    came = both.select("topic", *[F.col(f"_{c}").alias(c) for c in ("category", "sentiment", "sentiment_score")])
    return came, both.select(*CELL, "sentiment_score")


def best_items(mentions: DataFrame, k: int = KEPT_ITEMS) -> DataFrame:
    """Items state of a batch: its k best per topic, with the excerpt that a report shows."""
    title = F.nullif(F.col("title"), F.lit(""))
    items = mentions.select(
        "topic", "id", "created_at", "points", "url",
        truncate(F.coalesce(title, F.col("text")), LABEL_CHARS).alias("label"),
    )
    return _best(items, k).drop("rank")


def _best(items: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("topic").orderBy(*best_first()))
    return items.withColumn("rank", place).where(F.col("rank") <= k)


def merge_items(states: DataFrame, k: int = KEPT_ITEMS) -> DataFrame:
    """The k best per topic of all batches; an item that two batches hold counts once."""
    once = states.groupBy("topic", "id").agg(*[F.first(c).alias(c) for c in ("created_at", "points", "url", "label")])
    return _best(once, k)


def sentiment_by_topic(counts: DataFrame) -> DataFrame:
    """As `report.sentiment_by_topic`, from a counts state."""
    def of(sentiment: str) -> Column:
        return F.sum(F.when(F.col("sentiment") == sentiment, F.col("n")).otherwise(0)).alias(sentiment)

    mean = F.sum("score_sum").cast("double") / F.nullif(F.sum("scored"), F.lit(0))
    grouped = counts.groupBy("topic").agg(
        F.sum("n").alias("total"), *map(of, ("positive", "neutral", "negative")), F.round(mean, 3).alias("mean_score")
    )
    return grouped.where("total > 0").orderBy(F.col("mean_score").desc_nulls_last(), "topic")


def category_distribution(counts: DataFrame) -> DataFrame:
    """As `report.category_distribution`, from a counts state."""
    sums = counts.groupBy("category").agg(F.sum("n").alias("n")).where("n > 0")
    # One row per category is left here, so the window without keys is tiny.
    total = F.sum("n").over(Window.partitionBy())
    shares = sums.withColumn("share_pct", percent(F.col("n"), total))
    return shares.orderBy(F.col("n").desc(), F.col("category").asc_nulls_last())


def headline_counts(counts: DataFrame, quarantined: int) -> DataFrame:
    """As `report.headline_counts`, from a counts state and the size of the quarantine."""
    missing = F.col("sentiment").isNull() | F.col("category").isNull()
    by_topic = counts.groupBy("topic").agg(
        F.sum("n").alias("n"), F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("open")
    ).where("n > 0")
    zero = F.lit(0).cast("bigint")
    return by_topic.agg(
        F.coalesce(F.sum("n"), zero).alias("total"), F.count("topic").alias("topics"),
        F.lit(quarantined).cast("bigint").alias("quarantined"), F.coalesce(F.sum("open"), zero).alias("unlabelled"),
    )


def distinct_topics(counts: DataFrame) -> DataFrame:
    """Topics that hold a mention."""
    return counts.groupBy("topic").agg(F.sum("n").alias("n")).where("n > 0").select("topic").orderBy("topic")


def top_items(items: DataFrame, labels: DataFrame, k: int = TOP_ITEMS_PER_TOPIC) -> DataFrame:
    """As `report.top_items_per_topic`, from an items state and the current `labels(id, sentiment, category)`."""
    if k > KEPT_ITEMS:
        raise ValueError(f"batches keep {KEPT_ITEMS} items per topic, not {k}")
    # As many rows as topics and k give, so the labels need not move.
    best = merge_items(items, k)
    return best.join(labels.select("id", "sentiment", "category"), "id", "left").select(
        "topic", "rank", "id", "label", "sentiment", "category",
        F.coalesce(F.col("points").cast("string"), F.lit("-")).alias("points"), "url",
    )
