"""Classifier evaluation: sample for hand labels, then score the filled labels.

Every metric comes from the confusion counts, which are as small as the label
set squared; the rows themselves are aggregated once, map side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.text import is_blank, strip, truncate
from hearsay.settings import EXCERPT_CHARS, SAMPLE_SEED, SAMPLE_SIZE

# Fixed value: columns of the hand-label file, in order.
GOLD_COLUMNS = (
    "id", "topic", "text", "predicted_sentiment", "predicted_category",
    "true_sentiment", "true_category",
)
KINDS = ("sentiment", "category")


def seeded_sample(mentions: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """The same `size` labelled rows for the same seed, however the data is split."""
    key = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("id")), 256)
    return mentions.filter("sentiment is not null").orderBy(key, "id").limit(size)


def gold_template(mentions: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """Sampled rows with predictions, and blank columns for a person to fill in."""
    return seeded_sample(mentions, size, seed).select(
        "id", "topic", "text",
        F.col("sentiment").alias("predicted_sentiment"),
        F.col("category").alias("predicted_category"),
        F.lit("").alias("true_sentiment"), F.lit("").alias("true_category"),
    )


def _plain(label: Column) -> Column:
    return F.lower(strip(label))


def label_pairs(gold: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """`(kind, true, predicted)` of every row a person has labelled.

    A blank or missing prediction is a prediction like any other, and wrong.
    """
    stacked = gold.select(F.inline(F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.col(f"true_{kind}").alias("true"),
            F.col(f"predicted_{kind}").alias("predicted"),
        )
        for kind in kinds
    ])))
    filled = stacked.filter(~is_blank(F.col("true")))
    predicted = F.coalesce(_plain(F.col("predicted")), F.lit(""))
    return filled.select("kind", _plain(F.col("true")).alias("true"), predicted.alias("predicted"))


def confusion_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("kind", "true", "predicted").agg(F.count(F.lit(1)).alias("n"))


def accuracy(confusion: DataFrame) -> DataFrame:
    """Correct, total and accuracy per kind."""
    right = F.coalesce(F.sum(F.when(F.col("true") == F.col("predicted"), F.col("n"))), F.lit(0))
    grouped = confusion.groupBy("kind").agg(right.alias("correct"), F.sum("n").alias("n"))
    return grouped.withColumn("accuracy", _ratio(F.col("correct"), F.col("n")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def label_universe(pairs: DataFrame) -> DataFrame:
    """Every label seen as true or predicted, of label pairs or their counts."""
    seen = pairs.select("kind", F.explode(F.array("true", "predicted")).alias("label"))
    return seen.distinct().orderBy("kind", "label")


def confusion_grid(confusion: DataFrame) -> DataFrame:
    """Every pair of labels of a kind, `(kind, true, predicted, n)`, zeros filled.

    Labels come from the data, seen as true or predicted, so none is left out;
    the grid is as small as the label set squared.
    """
    universe = label_universe(confusion)
    cells = universe.withColumnRenamed("label", "true").join(
        universe.withColumnRenamed("label", "predicted"), "kind"
    )
    counted = cells.join(confusion, ["kind", "true", "predicted"], "left")
    return counted.select("kind", "true", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 per kind and label; 0 for a zero denominator."""
    hit = F.when(F.col("true") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = confusion.select("kind", F.inline(F.array(
        F.struct(F.col("true").alias("label"), F.col("n").alias("support"), zero.alias("guessed"), hit.alias("tp")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("tp")),
    )))
    sums = sides.groupBy("kind", "label").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("tp").alias("tp")
    )
    rates = sums.select(
        "kind", "label", "support",
        _ratio(F.col("tp"), F.col("guessed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    return rates.withColumn("f1", f1).orderBy("kind", "label")


def evaluation_report(pairs: DataFrame) -> DataFrame:
    """Per kind with labels: one `accuracy` row, then metric and confusion rows.

    Long form `(kind, section, label, predicted, value)`; no rows when nothing
    is labelled yet.
    """
    confusion = confusion_counts(pairs)
    text = F.lit(None).cast("string")
    overall = accuracy(confusion).select(
        "kind", F.lit("accuracy").alias("section"), text.alias("label"), text.alias("predicted"),
        F.col("accuracy").alias("value"),
    )
    names = ("support", "precision", "recall", "f1")
    metrics = class_metrics(confusion).select("kind", "label", F.inline(F.array(*[
        F.struct(F.lit(m).alias("section"), F.col(m).cast("double").alias("value")) for m in names
    ]))).select("kind", "section", "label", text.alias("predicted"), "value")
    counts = confusion_grid(confusion).select(
        "kind", F.lit("confusion").alias("section"), F.col("true").alias("label"), "predicted",
        F.col("n").cast("double").alias("value"),
    )
    return overall.unionByName(metrics).unionByName(counts)


def disagreements(gold: DataFrame, kind: str = "sentiment", first: int = 10) -> DataFrame:
    """The first rows, by id, whose label differs from the prediction."""
    true, predicted = F.col(f"true_{kind}"), F.col(f"predicted_{kind}")
    differs = ~is_blank(true) & (_plain(true) != F.coalesce(_plain(predicted), F.lit("")))
    excerpt = F.replace(truncate(F.col("text"), EXCERPT_CHARS), F.lit("|"), F.lit("\\|"))
    chosen = gold.filter(differs).orderBy("id").limit(first)
    return chosen.select(
        "id", "topic", excerpt.alias("text"), predicted.alias("predicted"), true.alias("true")
    )
