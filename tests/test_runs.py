"""Landing, paging, full runs, incremental runs: idempotency and counters."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hearsay.operators.pages import (
    accepted_pages, advance, capped_hits, capped_pages, frontier, named_pages, paging_after, topic_frame,
)
from hearsay.operators.runs import run_history
from hearsay.operators.upsert import insert_or_ignore, last_per_id
from hearsay.plans.ingest import run
from hearsay.plans.report import summary
from hearsay.settings import RunSettings, Topic
from hearsay.sources.landing import (
    corrupt_pages, land, read_landing, scan_page_files, with_page_facts,
)
from hearsay.sources.reports import write_sections
from hearsay.sources.store import MentionStore
from hearsay.streaming.ingest import ingest_arrivals, ingest_stream, land_stream, with_payload

AT = datetime(2026, 1, 1, tzinfo=timezone.utc)
SETTINGS = RunSettings(topics=(Topic("one"), Topic("two")), hits_per_page=2, max_items_per_topic=5)
STORES = iter(range(1000))


def hit(key, **more):
    return {"objectID": key, "title": f"Announcing good thing {key}", "created_at_i": 1_700_000_000,
            "points": 1} | more


def write_page(folder, topic, page, hits, **more):
    path = folder / topic
    path.mkdir(parents=True, exist_ok=True)
    (path / f"page_{page:03d}.json").write_text(json.dumps({"hits": hits} | more, ensure_ascii=False))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    write_page(folder, "one", 0, [hit("1"), hit("2")])
    write_page(folder, "one", 1, [hit("3"), hit(None)])
    write_page(folder, "two", 0, [hit("2", points=9), 5])
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return MentionStore(spark, f"store_{next(STORES)}", str(tmp_path / "store"), buckets=2)


def facts(spark, *rows):
    return spark.createDataFrame(rows, "topic string, page int, n_hits int, nb_pages bigint")


def last_pages(spark, frame, max_pages=None):
    topics = topic_frame(spark, [Topic(t) for t in "abcdefg"])
    return {r.topic: r.last_page for r in frontier(frame, topics, 7, max_pages).collect()}


def test_frontier(spark):
    frame = facts(
        spark,
        *[("a", p, 2, None) for p in range(5)],                      # all
        ("b", 0, 2, None), ("b", 2, 2, None),                        # gap
        ("c", 0, 2, None), ("c", 1, None, None), ("c", 2, 2, None),  # corrupt
        ("d", 0, 2, None), ("d", 1, 0, None), ("d", 2, 2, None),     # empty page counts, then stops
        ("e", 0, 2, 2), ("e", 1, 2, 2), ("e", 2, 2, 2),              # source has two pages
        ("f", 1, 2, None),                                           # no first page
        ("x", 0, 2, None),                                           # not configured
    )
    assert last_pages(spark, frame) == {"a": 4, "b": 0, "c": 0, "d": 1, "e": 1}
    assert last_pages(spark, frame, 2) == {"a": 1, "b": 0, "c": 0, "d": 1, "e": 1}
    topics = topic_frame(spark, [Topic(t) for t in "abcdefg"])
    assert accepted_pages(frame, topics, 7).count() == 5 + 1 + 1 + 2 + 2


def test_cap_counts_hits_over_pages(spark):
    pages = spark.createDataFrame(
        [("a", p, json.dumps({"hits": list(range(n))})) for p, n in enumerate((3, 1, 2, 2))],
        "topic string, page int, payload string",
    )
    topics = topic_frame(spark, [Topic("a")])
    hits = capped_hits(with_page_facts(pages), topics, 1, 2, 5)
    assert sorted((r.page, r.pos) for r in hits.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0)]


def test_page_facts(spark):
    payloads = ['{"hits": [1, 2], "nbPages": 3}', '{"x": 1}', '{"hits": null}', "[1]", "{broken", ""]
    pages = spark.createDataFrame(
        [("t", i, p) for i, p in enumerate(payloads)], "topic string, page int, payload string"
    )
    rows = with_page_facts(pages).orderBy("page").collect()
    assert [(r.n_hits, r.nb_pages) for r in rows] == [
        (2, 3), (0, None), (0, None), (None, None), (None, None), (None, None)
    ]
    assert corrupt_pages(with_page_facts(pages)).count() == 3


def test_landing_skips_what_is_landed(spark, raw, tmp_path):
    landing = str(tmp_path / "landing")
    (raw / "two" / "page_001.json").write_text("{broken")
    for _ in range(2):
        land(spark, scan_page_files(spark, str(raw)), landing)
        assert read_landing(spark, landing).count() == 4
    payload = read_landing(spark, landing).filter("topic = 'one' and page = 0").first().payload
    assert payload == (raw / "one" / "page_000.json").read_text()
    # The corrupt page may be landed again once it is readable.
    write_page(raw, "two", 1, [hit("7")])
    land(spark, scan_page_files(spark, str(raw)), landing)
    assert read_landing(spark, landing).filter("n_hits is not null").count() == 4


def test_folders_get_their_topic_names(spark, tmp_path):
    for folder, keys in (("C__", "12"), ("é_1", "3"), ("other", "4")):
        write_page(tmp_path, folder, 0, [hit(k) for k in keys])
    topics = [Topic("C++"), Topic("é 1"), Topic("none")]
    pages = with_page_facts(named_pages(scan_page_files(spark, str(tmp_path)), topics))
    assert {(r.topic, r.page, r.n_hits) for r in pages.collect()} == {("C++", 0, 2), ("é 1", 0, 1)}


def counters(row):
    return {k: row[k] for k in ("from_cache", "normalised", "quarantined", "inserted", "duplicates", "classified")}


def test_second_run_changes_nothing(spark, raw, store, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, scan_page_files(spark, str(raw)), landing)
    first = run(spark, landing, store, SETTINGS, "r1", AT, AT + timedelta(seconds=5))
    assert counters(first) == dict(from_cache=3, normalised=4, quarantined=2, inserted=3, duplicates=0, classified=3)
    rows = {r.id: r for r in store.mentions().collect()}
    # The later topic wins a shared id on its first run.
    assert {k: r.topic for k, r in rows.items()} == {"1": "one", "2": "two", "3": "one"}
    assert rows["2"].points == 9
    assert {(r.sentiment, r.category) for r in rows.values()} == {("positive", "product_launch")}
    later = AT + timedelta(hours=1)
    second = run(spark, landing, store, SETTINGS, "r2", later, later + timedelta(seconds=5))
    assert counters(second) == dict(from_cache=3, normalised=4, quarantined=2, inserted=0, duplicates=3, classified=0)
    assert {r.id: r for r in store.mentions().collect()} == rows
    assert store.quarantine().count() == 2
    assert store.table("mention_labels").count() == 3
    assert [r.n for r in store.count("quarantine").collect()] == [2]
    with pytest.raises(ValueError):
        store.count("secrets")
    history = run_history(store.run_log()).collect()
    assert [(r.run_id, r.inserted) for r in history] == [("r2", 0), ("r1", 3)]

    sections = summary(store.mentions(), store.quarantine(), store.run_log(), 1)
    write_sections(sections, str(tmp_path / "report"))
    write_sections(sections, str(tmp_path / "report_csv"), "csv")
    head = spark.read.parquet(str(tmp_path / "report/headline")).first()
    assert tuple(head) == (3, 2, 2, 0)
    assert spark.read.csv(str(tmp_path / "report_csv/top_items"), header=True).count() == 2


def test_unfinished_and_restarted_runs(spark, store):
    store.log_event("a", "start", AT)
    store.log_event("a", "finish", AT + timedelta(seconds=1), {"inserted": 4})
    store.log_event("b", "start", AT)
    store.log_event("c", "finish", AT, {"inserted": 1})
    rows = {r.run_id: r for r in store.run_log().collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].inserted, rows["b"].finished_at) == (4, None)
    store.log_event("a", "start", AT + timedelta(seconds=2))
    again = {r.run_id: r for r in store.run_log().collect()}["a"]
    assert (again.inserted, again.finished_at) == (0, None)
    assert run_history(store.run_log()).count() == 0


def exchanges(spark, frame):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return frame._jdf.queryExecution().explainString(mode).count("Exchange hashpartitioning")


def test_store_side_is_not_shuffled(spark, tmp_path):
    store = MentionStore(spark, f"store_{next(STORES)}", str(tmp_path / "store"))
    rows = spark.range(100).select(
        F.col("id").cast("string"), F.lit("t").alias("topic"), F.lit(0).alias("topic_order"),
        F.lit(0).alias("page"), F.col("id").alias("pos"),
    )
    stored = store.table("mentions_base")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        # Only the batch is shuffled, once: for its dedupe, by the bucket key.
        assert exchanges(spark, insert_or_ignore(last_per_id(rows), stored, "id")) == 1
        # Labels meet mentions without any shuffle.
        assert exchanges(spark, store.mentions()) == 0
        assert exchanges(spark, store.unlabelled_ids()) == 0
    finally:
        spark.conf.set(key, before)


def test_half_done_run_is_repaired(spark, raw, store, tmp_path):
    """A run that stored mentions but died before labelling them."""
    landing = str(tmp_path / "landing")
    land(spark, scan_page_files(spark, str(raw)), landing)
    lost = spark.createDataFrame(
        [("1", "one", "old", "old text", AT)],
        "id string, topic string, source string, text string, created_at timestamp",
    )
    for name in ("author", "title", "url"):
        lost = lost.withColumn(name, F.lit(None).cast("string"))
    for name in ("points", "num_comments"):
        lost = lost.withColumn(name, F.lit(None).cast("bigint"))
    store.append(lost.withColumn("fetched_at", F.col("created_at")), "mentions_base")
    done = run(spark, landing, store, SETTINGS, "r1", AT)
    assert counters(done) == dict(from_cache=3, normalised=4, quarantined=2, inserted=2, duplicates=1, classified=3)
    row = store.mentions().filter("id = '1'").first()
    assert (row.text, row.sentiment, row.category) == ("old text", "neutral", "other")


def test_streams_load_only_what_is_new(spark, raw, store, tmp_path):
    landing, marks = str(tmp_path / "landing"), tmp_path / "marks"
    late = raw / "two" / "page_000.json"
    content = late.read_text()
    late.unlink()
    write_page(raw, "two", 1, [hit("8")])

    def go(at):
        land_stream(spark, str(raw), landing, SETTINGS.topics, str(marks / "land")).awaitTermination()
        ingest_stream(spark, landing, store, SETTINGS, str(marks / "ingest"), lambda: at).awaitTermination()
        return {r.id: r.topic for r in store.mentions().collect()}

    assert go(AT) == {"1": "one", "2": "one", "3": "one"}
    # The missing page arrives and unblocks the next one; known ids never move.
    late.write_text(content)
    want = {"1": "one", "2": "one", "3": "one", "8": "two"}
    assert go(AT + timedelta(hours=1)) == want
    assert go(AT + timedelta(hours=2)) == want
    assert {tuple(r) for r in store.table("paging").collect()} == {("one", 2, 4, False), ("two", 2, 3, False)}
    assert store.table("mention_labels").count() == 4
    assert store.mentions().filter("sentiment is null or category is null").count() == 0


def test_paging_goes_on_from_its_state(spark):
    """Gaps, caps, ends, pages of the past and replays, against the whole history read at once."""
    facts_of = lambda *rows: facts(spark, *rows)
    pages = [*[("a", p, 2, None) for p in (0, 1, 2, 4)], ("b", 0, 2, 2), ("b", 1, 2, 2), ("c", 1, 3, None), ("d", 0, 0, None), ("d", 1, 2, None)]
    whole = facts_of(*pages)
    topics = topic_frame(spark, [Topic(t) for t in "abcd"]).select("topic", "topic_order")
    for cap in (None, 5, 4):
        want = {(r.topic, r.page, r.take) for r in capped_pages(whole, topics, 4, 2, cap).collect()}
        start = topics.withColumns({"next_page": F.lit(0), "taken": F.lit(0).cast("bigint")})
        assert {(r.topic, r.page, r.take) for r in advance(whole, start, 4, 2, cap).collect()} == want
        # The first page of each topic, then the rest from the state that this leaves.
        first = advance(whole.filter("page = 0"), start, 4, 2, cap)
        state = paging_after(first)
        then = topics.join(state.filter("not ended"), "topic").select("topic", "topic_order", "next_page", "taken")
        rest = advance(whole, then, 4, 2, cap)
        got = [(r.topic, r.page, r.take) for r in first.union(rest).collect()]
        assert sorted(got) == sorted(want)
        assert {r.topic for r in state.filter("ended").collect()} == {"d"}
    # The missing page lets the one behind the gap go on.
    more = whole.union(facts_of(("a", 3, 2, None), ("c", 0, 1, None)))
    at = topics.filter("topic in ('a', 'c')").withColumns({"next_page": F.when(F.col("topic") == "a", 3).otherwise(0), "taken": F.lit(0).cast("bigint")})
    assert {(r.topic, r.page) for r in advance(more, at, 4, 2, None).collect()} == {("a", 3), ("a", 4), ("c", 0), ("c", 1)}


def test_batches_look_ahead_only(spark, raw, store, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, named_pages(scan_page_files(spark, str(raw)), SETTINGS.topics), landing)
    arrivals = spark.createDataFrame([("one", 0), ("one", 1)], "topic string, page int")
    assert ingest_arrivals(arrivals, landing, store, SETTINGS, AT)["inserted"] == 3
    # A replay, and a page of the past, load nothing again.
    for _ in range(2):
        done = ingest_arrivals(arrivals, landing, store, SETTINGS, AT)
        assert (done["normalised"], done["inserted"]) == (0, 0)
    assert {tuple(r) for r in store.table("paging").collect()} == {("one", 2, 4, False)}


def test_streams_start_on_an_empty_landing_area(spark, raw, store, tmp_path):
    landing, marks = str(tmp_path / "landing"), str(tmp_path / "marks")
    ingest_stream(spark, landing, store, SETTINGS, marks, lambda: AT).awaitTermination()
    assert store.count().first()["n"] == 0
    land(spark, named_pages(scan_page_files(spark, str(raw)), SETTINGS.topics), landing)
    ingest_stream(spark, landing, store, SETTINGS, marks, lambda: AT).awaitTermination()
    assert store.count().first()["n"] == 3


def test_payloads_of_open_pages_are_not_shuffled(spark, raw, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, named_pages(scan_page_files(spark, str(raw)), SETTINGS.topics), landing)
    chosen = spark.createDataFrame([("one", 0, 1, 2)], "topic string, topic_order int, page int, take int")
    found = with_payload(read_landing(spark, landing), chosen)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "dynamicpruning" in plan
    assert "GreaterThanOrEqual(page,1)" in plan and "LessThanOrEqual(page,1)" in plan
    assert [(r.topic, r.page) for r in found.collect()] == [("one", 1)]
    nothing = chosen.limit(0)
    assert with_payload(read_landing(spark, landing), nothing).isEmpty()


def test_no_staging_stays_behind(spark, raw, store, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("hearsay.session.shared_folder", lambda _, name: str(shared / name))
    landing = str(tmp_path / "landing")
    land(spark, named_pages(scan_page_files(spark, str(raw)), SETTINGS.topics), landing)
    assert run(spark, landing, store, SETTINGS, "r", AT)["inserted"] == 3
    assert shared.exists() and not any(shared.iterdir())
