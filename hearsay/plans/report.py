"""The two reports as DataFrames, and writing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearsay.operators import evaluate as ev
from hearsay.operators import report as rep
from hearsay.operators.runs import run_history
from hearsay.settings import TOP_ITEMS_PER_TOPIC
from hearsay.sources.gold import read_filled_gold
from hearsay.sources.reports import write_sections


def summary(
    mentions: DataFrame, quarantine: DataFrame, log: DataFrame, k: int = TOP_ITEMS_PER_TOPIC
) -> dict[str, DataFrame]:
    """Sections of the summary report, by name."""
    by_topic = rep.sentiment_by_topic(mentions)
    return {
        "headline": rep.headline_counts(mentions, quarantine),
        "sentiment_by_topic": by_topic,
        "sentiment_share": rep.sentiment_share(by_topic),
        "category_distribution": rep.category_distribution(mentions),
        "top_items": rep.top_items_per_topic(mentions, k),
        "run_history": run_history(log),
    }


def evaluation(gold: DataFrame) -> dict[str, DataFrame]:
    """Sections of the evaluation report, by name."""
    pairs = ev.label_pairs(gold)
    confusion = ev.confusion_counts(pairs)
    return {
        "accuracy": ev.accuracy(confusion),
        "class_metrics": ev.class_metrics(confusion),
        "confusion": ev.confusion_grid(confusion),
        "disagreements": ev.disagreements(gold),
    }


def score_gold(spark: SparkSession, gold_path: str, folder: str) -> bool:
    """Score the hand-label file into `folder`.

    False, and nothing written, if the file is missing or holds no label yet.
    """
    gold = read_filled_gold(spark, gold_path)
    if gold is None or ev.label_pairs(gold).isEmpty():
        return False
    write_sections(evaluation(gold), folder)
    return True
