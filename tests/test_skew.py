"""One key holding a third of all rows, against brute force."""

from pyspark.sql import functions as F

from hearsay.operators.pages import frontier, topic_frame
from hearsay.operators.report import top_items_per_topic
from hearsay.operators.upsert import first_per_payload, last_per_id
from hearsay.settings import Topic

ROWS = 6000


def test_hot_id(spark):
    rows = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("id"),
        F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("topic"),
        (F.col("id") % 5).cast("int").alias("topic_order"),
        (F.col("id") % 97).cast("int").alias("page"), F.col("id").alias("pos"),
    )
    want = {}
    for r in rows.collect():
        key = (r.topic_order, r.topic, r.page, r.pos)
        want[r.id] = max(want.get(r.id, key), key)
    got = last_per_id(rows.withColumn("kept", F.struct("topic_order", "topic", "page", "pos")))
    assert {r.id: tuple(r.kept) for r in got.collect()} == want


def test_hot_payload(spark):
    rows = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("payload_hash"),
        F.lit("t").alias("topic"), F.lit(0).alias("topic_order"), F.lit(0).alias("page"),
        F.col("id").alias("pos"), F.col("id").cast("string").alias("raw_id"),
        F.lit("r").alias("reason"), F.lit("p").alias("payload"), F.lit(None).alias("recorded_at"),
    )
    kept = first_per_payload(rows)
    assert kept.count() == 1 + ROWS - ROWS // 3
    assert kept.filter("payload_hash = 'hot'").first().raw_id == "0"


def test_top_items_of_a_hot_topic(spark):
    mentions = spark.range(ROWS).select(
        F.col("id").cast("string"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("topic"),
        F.timestamp_seconds(F.col("id") % 11).alias("created_at"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 100).alias("points"),
        F.lit("s").alias("sentiment"), F.lit("c").alias("category"), F.lit("u").alias("url"),
        F.lit(None).cast("string").alias("title"), F.lit("x").alias("text"),
    )
    groups = {}
    for r in mentions.collect():
        groups.setdefault(r.topic, []).append((-(r.points or 0), -r.created_at.timestamp(), r.id))
    # The second k is past Spark's limit for partial group limits and is salted.
    for k in (3, 1500):
        want = {(t, i + 1, x[2]) for t, xs in groups.items() for i, x in enumerate(sorted(xs)[:k])}
        got = {(r.topic, r["rank"], r.id) for r in top_items_per_topic(mentions, k).collect()}
        assert got == want


def test_long_topic(spark):
    """A topic of thousands of pages with one gap."""
    facts = spark.range(ROWS).filter("id <> 4321").select(
        F.lit("a").alias("topic"), F.col("id").cast("int").alias("page"), F.lit(20).alias("n_hits"),
        F.lit(None).cast("bigint").alias("nb_pages"),
    )
    ends = frontier(facts, topic_frame(spark, [Topic("a")]), 1)
    assert [r.last_page for r in ends.collect()] == [4320]
