"""Sampling, the hand-label file, and the published evaluation figures."""

import pytest
from pyspark.sql import functions as F

from hearsay.operators import evaluate as ev
from hearsay.plans.report import score_gold
from hearsay.sources.gold import export_gold_template, read_gold

# Counts of (true, predicted) in a hand-labelled sample of 25 rows.
SENTIMENT = {
    ("negative", "negative"): 6, ("negative", "neutral"): 2, ("neutral", "neutral"): 12,
    ("positive", "neutral"): 3, ("positive", "positive"): 2,
}
CATEGORY = {
    ("business_news", "product_launch"): 1, ("criticism", "criticism"): 1, ("criticism", "other"): 1,
    ("criticism", "technical_discussion"): 1, ("other", "criticism"): 1, ("other", "other"): 6,
    ("product_launch", "other"): 1, ("product_launch", "product_launch"): 1,
    ("product_launch", "technical_discussion"): 1, ("technical_discussion", "other"): 2,
    ("technical_discussion", "technical_discussion"): 9,
}


def expand(counts):
    return [pair for pair, n in counts.items() for _ in range(n)]


@pytest.fixture
def gold(spark):
    rows = [
        (str(i), "t", "a|b", f" {sp} ".upper(), cp, f"{st} ", ct)
        for i, ((st, sp), (ct, cp)) in enumerate(zip(expand(SENTIMENT), expand(CATEGORY)))
    ]
    return spark.createDataFrame(rows, list(ev.GOLD_COLUMNS))


def test_published_figures(gold):
    confusion = ev.confusion_counts(ev.label_pairs(gold))
    accuracy = {r.kind: (r.correct, r.n, r.accuracy) for r in ev.accuracy(confusion).collect()}
    assert accuracy == {"sentiment": (20, 25, 0.8), "category": (17, 25, 0.68)}
    got = {
        (r.kind, r.label): (r.support, round(r.precision, 2), round(r.recall, 2), round(r.f1, 2))
        for r in ev.class_metrics(confusion).collect()
    }
    assert got == {
        ("sentiment", "negative"): (8, 1.00, 0.75, 0.86),
        ("sentiment", "neutral"): (12, 0.71, 1.00, 0.83),
        ("sentiment", "positive"): (5, 1.00, 0.40, 0.57),
        ("category", "business_news"): (1, 0.0, 0.0, 0.0),
        ("category", "criticism"): (3, 0.50, 0.33, 0.40),
        ("category", "other"): (7, 0.60, 0.86, 0.71),
        ("category", "product_launch"): (3, 0.50, 0.33, 0.40),
        ("category", "technical_discussion"): (11, 0.82, 0.82, 0.82),
    }


def test_grid_has_every_label(gold):
    grid = ev.confusion_grid(ev.confusion_counts(ev.label_pairs(gold)))
    cells = {(r.true, r.predicted): r.n for r in grid.collect() if r.kind == "sentiment"}
    labels = ("negative", "neutral", "positive")
    rows = {x: tuple(cells[x, y] for y in labels) for x in labels}
    assert len(cells) == 9
    assert rows == {"negative": (6, 2, 0), "neutral": (0, 12, 0), "positive": (0, 3, 2)}
    kinds = {r.kind: r.n for r in grid.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {"sentiment": 9, "category": 25}


def test_disagreements(gold):
    rows = ev.disagreements(gold).collect()
    assert len(rows) == 5 and {r.text for r in rows} == {"a\\|b"}


def mentions(spark, n):
    frame = spark.range(n).select(F.col("id").cast("string").alias("id"))
    return frame.select(
        "id", F.lit("t").alias("topic"), F.lit('say "hi",\nthere').alias("text"),
        F.when(F.col("id") != "0", "neutral").alias("sentiment"), F.lit("other").alias("category"),
    )


def test_sample_does_not_depend_on_partitions(spark):
    a = ev.seeded_sample(mentions(spark, 500)).collect()
    b = ev.seeded_sample(mentions(spark, 500).repartition(7)).collect()
    assert a == b and len(a) == 25
    assert [r.id for r in ev.seeded_sample(mentions(spark, 500), seed=1).collect()] != [r.id for r in a]
    assert ev.seeded_sample(mentions(spark, 5)).count() == 4


def test_template_is_written_once(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert export_gold_template(mentions(spark, 1), path) == 0 and not (tmp_path / "gold").exists()
    assert export_gold_template(mentions(spark, 100), path, 10) == 10
    assert export_gold_template(mentions(spark, 200), path) == 0
    rows = read_gold(spark, path).collect()
    assert len(rows) == 10 and {r.text for r in rows} == {'say "hi",\nthere'}
    # Nothing is labelled yet, so there is no report.
    assert score_gold(spark, path, str(tmp_path / "report")) is False
    assert score_gold(spark, str(tmp_path / "none"), str(tmp_path / "report")) is False
    assert not (tmp_path / "report").exists()


def test_score_a_filled_file(spark, gold, tmp_path):
    (tmp_path / "gold.csv").write_text(
        ",".join(ev.GOLD_COLUMNS) + "\n" + "\n".join(",".join(r) for r in gold.collect())
        + "\nshort,row\n"
    )
    assert score_gold(spark, str(tmp_path / "gold.csv"), str(tmp_path / "report")) is True
    rows = spark.read.parquet(str(tmp_path / "report/accuracy")).collect()
    assert {r.kind: r.correct for r in rows} == {"sentiment": 20, "category": 17}
