"""A store opened again under other settings, and labels given twice."""

import pytest

from hearsay.operators.upsert import apply_labels
from hearsay.sources.gold import read_gold
from hearsay.sources.store import MentionStore


def test_reopened_store_keeps_its_buckets(spark, tmp_path):
    folder = str(tmp_path / "store")
    first = MentionStore(spark, "reopen_a", folder, 3)
    again = MentionStore(spark, "reopen_b", folder)
    assert (first.buckets, again.buckets) == (3, 3)
    with pytest.raises(ValueError, match="3 buckets"):
        MentionStore(spark, "reopen_c", folder, 5)


def test_last_label_wins_without_new_rows(spark):
    mentions = spark.createDataFrame(
        [("1", None, None, None)], "id string, sentiment string, sentiment_score double, category string"
    )
    labels = spark.createDataFrame(
        [("1", "positive", 0.5, "a", 1), ("1", "negative", -0.5, "b", 2)],
        "id string, sentiment string, sentiment_score double, category string, labelled_at int",
    )
    assert [tuple(r) for r in apply_labels(mentions, labels).collect()] == [("1", "negative", -0.5, "b")]


def test_empty_gold_cells_are_blank_predictions(spark, tmp_path):
    path = tmp_path / "gold.csv"
    head = "id,topic,text,predicted_sentiment,predicted_category,true_sentiment,true_category"
    path.write_text(head + "\n1,t,x,,other,positive,other\nshort,row\n")
    rows = read_gold(spark, str(path)).collect()
    assert [(r.id, r.predicted_sentiment) for r in rows] == [("1", "")]
