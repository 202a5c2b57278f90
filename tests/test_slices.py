"""Pages are landed, and batches are loaded, in slices: only a slice's payloads are on disk twice."""

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import views
from hearsay.operators.pages import PageRun, cut_runs
from hearsay.settings import RunSettings, Topic
from hearsay.sources import landing
from hearsay.sources.landing import LANDING_SCHEMA, land, new_pages, read_landing, with_page_facts
from hearsay.sources.store import MentionStore
from hearsay.streaming import ingest

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SETTINGS = RunSettings(
    topics=tuple(map(Topic, ("one", "two", "three"))), hits_per_page=2, rules=[("other words", [r"\bword\b"])],
    categories=("other words",), lexicon={"text": 1.0}, sentiment_rules=views.WORDS,
)


def hit(key, **more):
    return {"objectID": key, "title": f"Text {key}", "created_at_i": 1_700_000_000, "points": 1} | more


def pages_of(spark, *rows):
    named = [(t, p, x if isinstance(x, str) else json.dumps({"hits": x})) for t, p, x in rows]
    return spark.createDataFrame(named, "topic string, page int, payload string")


PAGES = (
    ("one", 0, [hit("1"), hit("2")]), ("one", 1, [hit("3"), hit(None)]), ("one", 2, [hit("4"), hit(None)]),
    ("two", 0, [hit("2", points=9), 5]), ("two", 1, [hit("3", points=8), hit("5")]), ("two", 2, [hit("5", points=7), hit("6")]),
    ("three", 0, [hit("6", points=6), hit("1", points=5)]), ("three", 1, "{broken"),
)


def stored(spark, tmp_path, name):
    store = MentionStore(spark, f"slices_{name}", str(tmp_path / name), buckets=2)
    topics = spark.createDataFrame([(t.name, 0) for t in SETTINGS.topics], "topic string, page int")
    done = ingest.ingest_arrivals(topics, str(tmp_path / "landing"), store, SETTINGS, AT)
    rows = lambda frame: sorted(map(str, frame.collect()))
    kept = [rows(store.mentions()), rows(store.quarantine()), rows(store.table("paging"))]
    return done, kept, {k: rows(x) for k, x in store.report().items()}, store


def test_slices_load_what_the_whole_batch_loads(spark, tmp_path, monkeypatch):
    land(spark, pages_of(spark, *PAGES), str(tmp_path / "landing"))
    whole, *rest, _ = stored(spark, tmp_path, "whole")
    monkeypatch.setattr(ingest, "SLICE_HITS", 7)
    appended = []
    append = MentionStore.append
    monkeypatch.setattr(MentionStore, "append", lambda s, rows, table: (
        appended.append(rows.count()) if table == "mentions_base" else None, append(s, rows, table)))
    sliced, *same, store = stored(spark, tmp_path, "sliced")
    assert sliced == whole == dict(normalised=11, quarantined=3, inserted=6, duplicates=0, classified=6)
    assert same == rest
    # The last topic's record of an id is stored, and no slice held all of them.
    assert {r.id: (r.topic, r.points) for r in store.mentions().collect()} == {
        "1": ("three", 5), "2": ("two", 9), "3": ("two", 8), "4": ("one", 1), "5": ("two", 7), "6": ("three", 6)}
    assert sum(appended) == 6 and len(appended) == 2 and max(appended) <= 4


@pytest.mark.parametrize("slices", [1, 2, 3, 7])
def test_runs_are_cut_in_order(slices):
    runs = [PageRun("b", 1, 3, 9, 140, 9, 20), PageRun("a", 0, 0, 0, 3, 0, 3), PageRun("c", 2, 0, 4, 0, 4, 0), PageRun("d", 3, 5, 17, 260, 17, 20)]
    parts = cut_runs(runs, slices)[::-1]
    assert len(parts) == slices
    listed = [(r.topic, p) for part in parts for r in part for p in range(r.low, r.high + 1)]
    assert sorted(listed) == sorted((r.topic, p) for r in runs for p in range(r.low, r.high + 1))
    filled = [x for x in listed if x[0] != "c"]
    assert filled == sorted(filled)
    hits = [sum(r.hits * (r.high - r.low + 1) / (x.high - x.low + 1) for r in part for x in runs if x.topic == r.topic) for part in parts]
    assert max(hits) <= 403 / slices + 21


def test_payloads_of_many_open_pages_are_not_shuffled(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "landing")
    land(spark, pages_of(spark, *PAGES), place)
    monkeypatch.setattr("hearsay.session.BROADCAST_ROWS", 2)
    chosen = spark.createDataFrame(
        [("one", 0, 0, 2), ("one", 0, 1, 2), ("one", 0, 2, 1)], "topic string, topic_order int, page int, take int")
    found = ingest.with_payload(read_landing(spark, place), chosen)
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.topic, r.page, r.take) for r in found.collect()) == [("one", 0, 2), ("one", 1, 2), ("one", 2, 1)]


def key(row):
    return str(tuple(row[c] for c in ("topic", "page", "payload", "n_hits", "nb_pages")))


def test_landing_in_slices(spark, tmp_path, monkeypatch):
    """New, known, broken, repaired and repeated pages, and pages without a key, as `new_pages` has them."""
    monkeypatch.setattr(landing, "SLICE_PAGES", 2)
    second = (
        *PAGES, ("three", 1, [hit("9")]), ("three", 1, "{broken too"), ("two", 3, "{"), ("two", 3, []), ("four", 0, [hit("7")]),
        (None, 0, "{}"), ("one", None, "{}"), ("one", None, "{}"))
    place, want = str(tmp_path / "landing"), []
    for batch, few in ((PAGES, 100_000), (second, 0), ((second[-3], ("two", 4, []), *PAGES[:2]), 100_000)):
        monkeypatch.setattr(landing, "BROADCAST_ROWS", few)
        incoming = pages_of(spark, *batch)
        known = spark.createDataFrame(want, LANDING_SCHEMA)
        want = [tuple(r) for r in known.union(new_pages(with_page_facts(incoming), known)).collect()]
        land(spark, incoming, place)
        got = [key(r) for r in read_landing(spark, place).collect()]
        assert sorted(got) == sorted(key(r) for r in spark.createDataFrame(want, LANDING_SCHEMA).collect())
    files = sorted(Path(place).rglob("*.parquet"))
    land(spark, pages_of(spark, *PAGES[:-1]), place)
    assert sorted(Path(place).rglob("*.parquet")) == files
    assert all(".zstd." in f.name for f in files)


def test_documents_are_dealt_once_for_their_pages(spark, tmp_path):
    ids = [*range(0, 5000, 7), *range(-3000, 0, 11), 1199, 1200, 1200]
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", i % 50) for i in ids], "doc_id bigint, text string, lang string, source string, n_chars int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    pages = views.pages(spark, str(tmp_path))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(topic" not in plan
    hits = views.listed(spark, str(tmp_path)).groupBy("topic", "page").agg(
        F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("hits"))
    want = {(r.topic, r.page): ",".join(h.json for h in r.hits) for r in hits.collect()}
    got = {(r.topic, r.page): r.payload for r in pages.collect()}
    assert pages.count() == len(got) and set(got) == set(want) - {("s4", 2)}
    odd = {("s6", 1), ("s3", 2)}
    assert all(got[k].startswith('{"hits":[' + want[k] + "]") for k in set(got) - odd)
