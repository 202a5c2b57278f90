"""Landing deals pages once."""

from pyspark.sql import functions as F

from hearsay.sources.landing import LANDING_SCHEMA, new_pages, with_page_facts


def test_pages_dealt_by_their_key_are_not_dealt_again(spark):
    rows = [("t", 0, '{"hits":[1,2]}'), ("t", 1, "broken"), ("u", 0, '{"hits":[],"nbPages":1}')]
    hits = spark.createDataFrame(rows, "topic string, page int, payload string")
    pages = with_page_facts(hits.groupBy("topic", "page").agg(F.max("payload").alias("payload")))
    landed = spark.createDataFrame([("t", 0, "", 2, None)], LANDING_SCHEMA)
    fresh = new_pages(pages, landed)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    # One for the pages, at most one for the keys of those landed.
    assert plan.count("Exchange hashpartitioning") <= 2
    assert sorted((r["topic"], r["page"], r["n_hits"], r["nb_pages"]) for r in fresh.collect()) == sorted(
        [("t", 1, None, None), ("u", 0, 0, 1)], key=lambda r: r[:2])
