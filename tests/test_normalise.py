"""Raw hits to records, and reject reasons."""

import json

from pyspark.sql import functions as F

from hearsay.operators.normalise import assess_hits, missing_field, rejected_hits, valid_records

BASE = {
    "objectID": "123", "title": "Acme ships a quieter anvil", "author": "road_runner",
    "url": "https://example.org/anvil", "created_at_i": 1_700_000_000, "points": 42,
    "num_comments": 7,
}


def assess(spark, *raw):
    rows = [("t", 0, 0, i, json.dumps(r)) for i, r in enumerate(raw)]
    hits = spark.createDataFrame(rows, "topic string, topic_order int, page int, pos int, json string")
    hits = hits.withColumn("hit", F.parse_json("json")).drop("json")
    return assess_hits(hits, F.lit("2026-01-01 00:00:00").cast("timestamp"), "hn")


def one(spark, **changes):
    return assess(spark, BASE | changes).first()


def each(spark, key, values):
    """One row per value of a field, in order."""
    return assess(spark, *[BASE | {key: v} for v in values]).orderBy("pos").collect()


def test_field_mapping(spark):
    row = valid_records(assess(spark, BASE)).first()
    assert (row.id, row.topic, row.source, row.points, row.num_comments) == ("123", "t", "hn", 42, 7)
    assert row.created_at.strftime("%Y-%m-%d") == "2023-11-14"
    assert row.title == row.text == BASE["title"]
    assert (row.sentiment, row.sentiment_score, row.category) == (None, None, None)


def test_falsy_key_is_rejected(spark):
    rows = each(spark, "objectID", [None, "", 0, False, 0.0, [], {}])
    assert {r.reason for r in rows} == {"Hit has no objectID; cannot assign a stable key."}


def test_key_is_text(spark):
    rows = each(spark, "objectID", ["0", 7, True])
    assert [(r.reason, r.id) for r in rows] == [(None, "0"), (None, "7"), (None, "True")]


def test_blank_key_fails_the_required_field_check(spark):
    assert one(spark, objectID=" ").reason == "Record ' ' missing required field 'id'"


def test_body_when_title_is_missing(spark):
    row = one(spark, title=None, story_text="<i>Is the anvil loud?</i>")
    assert (row.title, row.text) == (None, "Is the anvil loud?")
    assert one(spark, title="<br>", comment_text="x &amp; y").text == "x & y"


def test_no_text_is_rejected(spark):
    # A story that only cleans to nothing still hides the comment.
    bodies = [{}, {"story_text": "<p></p>", "comment_text": "x"}, {"story_text": "", "comment_text": "x"}]
    rows = assess(spark, *[BASE | {"title": None} | b for b in bodies]).orderBy("pos").collect()
    want = "Hit 123 has neither title nor text."
    assert [(r.reason, r.text) for r in rows] == [(want, None), (want, None), (None, "x")]


def test_times(spark):
    iso = "2023-11-14T22:13:20Z"
    pairs = [(1_700_000_000, None), ("abc", iso), (None, iso), (None, "garbage"), (None, 5)]
    raw = [BASE | {"created_at_i": e, "created_at": t} for e, t in pairs]
    rows = assess(spark, *raw).orderBy("pos").collect()
    assert rows[0].created_at == rows[1].created_at == rows[2].created_at
    bad = "Hit 123 has no parseable creation timestamp."
    assert [r.reason for r in rows] == [None, None, None, bad, bad]


def test_tolerant_int(spark):
    cases = [
        (None, None), ("12", 12), (" 12 ", 12), (12.7, 12), ("12.5", None), ("x", None), ([1], None),
        (True, 1), (-7.9, -7),
    ]
    assert [r.points for r in each(spark, "points", [c[0] for c in cases])] == [c[1] for c in cases]


def test_defaults(spark):
    assert one(spark, author="").author is None
    links = {r.url for r in each(spark, "url", [None, ""])}
    assert links == {"https://news.ycombinator.com/item?id=123"}


def test_hit_must_be_an_object(spark):
    cases = [5, "a", 1.5, True, [1], None]
    names = ["int", "str", "float", "bool", "list", "NoneType"]
    rows = rejected_hits(assess(spark, *cases)).orderBy("pos").collect()
    assert [r.reason for r in rows] == [f"Expected a dict hit, got {n}" for n in names]
    assert {r.raw_id for r in rows} == {None}


def test_title_that_is_not_text(spark):
    assert one(spark, title=5).reason == "Hit 123 has a title that is not text."
    assert one(spark, title=0, story_text="x").text == "x"


def test_rejects_keep_the_whole_payload_and_its_hash(spark):
    long = {"objectID": None, "title": "x" * 3000}
    rows = rejected_hits(assess(spark, long, long | {"title": "x" * 4000})).collect()
    assert all(len(r.payload) > 3000 for r in rows)
    assert len({r.payload_hash for r in rows}) == 2


def test_required_fields_in_order(spark):
    frame = spark.createDataFrame(
        [("1", "t", "x", "d"), (None, None, "x", "d"), ("1", " ", None, "d"), ("1", "t", "", None),
         ("1", "t", "x", None)],
        "id string, topic string, text string, created_at string",
    )
    fields = {c: F.col(c) for c in frame.columns}
    got = [r[0] for r in frame.select(missing_field(F.col("id"), fields)).collect()]
    assert got == [
        None, "Record None missing required field 'id'", "Record '1' missing required field 'topic'",
        "Record '1' missing required field 'text'", "Record '1' missing required field 'created_at'",
    ]
