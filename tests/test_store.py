"""Store: compaction of buckets, report states of runs, and repair after a run that broke off."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hearsay.operators import report
from hearsay.plans import ingest
from hearsay.settings import RunSettings, Topic
from hearsay.sources.landing import land, read_landing
from hearsay.sources.store import MentionStore

AT = datetime(2026, 1, 1, tzinfo=timezone.utc)
SETTINGS = RunSettings(topics=(Topic("one"), Topic("two")), hits_per_page=3)
NAMES = iter(range(1000))


def open_store(spark, folder):
    return MentionStore(spark, f"kept_{next(NAMES)}", f"{folder}/store", buckets=3)


def mentions(spark, ids, topic="one"):
    rows = [(f"m{i}", topic, "s", None, f"Good {i}", f"text {i}", "u", AT, AT, i % 5, None) for i in ids]
    return spark.createDataFrame(rows, (
        "id string, topic string, source string, author string, title string, text string, url string, "
        "created_at timestamp, fetched_at timestamp, points bigint, num_comments bigint"))


def labels(spark, ids, category, at):
    return spark.createDataFrame([(f"m{i}", "positive", 0.5, category, None, at) for i in ids], (
        "id string, sentiment string, sentiment_score double, category string, matched_term string, labelled_at timestamp"))


def files_per_bucket(store, table):
    names = [r[0] for r in store.table(table).select("_metadata.file_path").distinct().collect()]
    buckets = [n.rsplit("_", 1)[-1].split(".")[0] for n in names]
    return max(buckets.count(b) for b in buckets)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_compaction(spark, tmp_path):
    store = open_store(spark, tmp_path)
    for batch in range(20):
        store.append(mentions(spark, range(batch * 10, batch * 10 + 10)), "mentions_base")
        store.append(labels(spark, range(batch * 5, batch * 5 + 10), f"c{batch}", AT + timedelta(hours=batch)), "mention_labels")
    # An append that was repeated after a crash.
    store.append(mentions(spark, [7]), "mentions_base")
    before = rows(store.mentions().distinct())
    assert files_per_bucket(store, "mentions_base") > 1
    assert store.compact("mentions_base") == 200 and store.compact("mention_labels", delete_old=True) == 105
    for table in ("mentions_base", "mention_labels"):
        assert files_per_bucket(store, table) == 1
    assert rows(store.mentions()) == before
    plan = store.mentions()._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 3 out of 3" in plan

    # Later appends and sessions use the new folder; a broken-off compaction is written anew.
    store.append(mentions(spark, [500]), "mentions_base")
    (tmp_path / "store" / "mentions_base.2").mkdir()
    (tmp_path / "store" / "mentions_base.2" / "part-left-over").write_text("x")
    again = open_store(spark, tmp_path)
    assert again.mentions().count() == 201 and again.compact("mentions_base", delete_old=True) == 201
    assert not (tmp_path / "store" / "mentions_base.1").exists()
    assert rows(again.mentions().where("id <> 'm500'")) == before
    with pytest.raises(ValueError, match="no key"):
        store.compact("run_events")


def test_compaction_of_an_empty_table(spark, tmp_path):
    store = open_store(spark, tmp_path)
    assert store.compact("quarantine") == 0 and store.quarantine().count() == 0


def landed(spark, folder, topic, page, keys):
    hits = [{"objectID": k, "title": f"Announcing good thing {k}" if k % 2 else f"A bad bug {k}", "created_at_i": 1_700_000_000 + k, "points": k} for k in keys]
    pages = spark.createDataFrame([(topic, page, json.dumps({"hits": [*hits, 5]}))], "topic string, page int, payload string")
    land(spark, pages, folder)


def same_reports(store):
    got, whole = store.report(2), store.mentions()
    assert rows(got["sentiment_by_topic"]) == rows(report.sentiment_by_topic(whole))
    assert rows(got["category_distribution"]) == rows(report.category_distribution(whole))
    assert rows(got["headline"]) == rows(report.headline_counts(whole, store.quarantine()).select(*got["headline"].columns))
    assert rows(got["topics"]) == rows(report.distinct_topics(whole))
    assert rows(got["top_items"]) == rows(report.top_items_per_topic(whole, 2))


def test_reports_follow_the_runs(spark, tmp_path, monkeypatch):
    store, place = open_store(spark, tmp_path), f"{tmp_path}/landing"

    def run(n):
        return ingest.ingest_hits(ingest.batch_hits(spark, read_landing(spark, place), SETTINGS), store, SETTINGS, AT + timedelta(hours=n))

    landed(spark, place, "one", 0, [1, 2, 3])
    assert run(0)["inserted"] == 3
    same_reports(store)
    landed(spark, place, "one", 1, [3, 4])
    landed(spark, place, "two", 0, [5, 6])
    # A mention that an earlier run stored without a label gets one now.
    store.append(mentions(spark, [77]), "mentions_base")
    store.rebuild_report()
    assert run(1) | {"quarantined": 0} == {"normalised": 7, "quarantined": 0, "inserted": 3, "duplicates": 3, "classified": 4}
    same_reports(store)
    assert run(2)["inserted"] == 0
    same_reports(store)

    # A run that breaks off behind its mentions leaves the states behind; the next run makes them anew.
    landed(spark, place, "two", 1, [8, 9])
    monkeypatch.setattr(store, "close_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        run(3)
    monkeypatch.undo()
    assert store.report()["headline"].first()["total"] == 7 and run(4)["inserted"] == 0
    same_reports(store)
    assert store.report()["headline"].first()["total"] == 9


def test_report_reads_no_mention(spark, tmp_path):
    store = open_store(spark, tmp_path)
    for frame in store.report().values():
        plan = frame._jdf.queryExecution().toString()
        assert "mentions_base" not in plan and "text#" not in plan
    assert store.report()["headline"].select("total", "topics", "unlabelled").first() == (0, 0, 0)
    assert store.report()["top_items"].withColumn("x", F.lit(1)).count() == 0
