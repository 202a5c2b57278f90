"""The full label of a text: sentiment, score, category and matched term."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay.functions.category import category_rules, enabled_rules
from hearsay.functions.lookup import let
from hearsay.functions.sentiment import lexicon_score, sentiment_bucket
from hearsay.settings import RunSettings


def classify(text: Column, settings: RunSettings) -> Column:
    """STRUCT<sentiment, score, category, matched_term>; a pure function of the text."""
    score = lexicon_score(text, settings.lexicon, settings.sentiment_rules)
    category = category_rules(text, enabled_rules(settings.rules, settings.categories))

    def bucket(value: Column) -> Column:
        return sentiment_bucket(
            text, value, settings.positive_threshold, settings.negative_threshold
        )

    sentiment = let(score, lambda s: F.struct(bucket(s).alias("sentiment"), s.alias("score")))
    return let(
        F.struct(sentiment.alias("s"), category.alias("c")),
        lambda both: F.struct(
            both["s"]["sentiment"].alias("sentiment"), both["s"]["score"].alias("score"),
            both["c"]["category"].alias("category"), both["c"]["matched_term"].alias("matched_term"),
        ),
    )
