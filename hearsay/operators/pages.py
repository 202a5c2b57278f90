"""Paging: which landed pages count, how many hits each gives, and their hits.

All decisions are made on page facts (topic, page, n_hits, nb_pages). No window
runs over a whole topic: the frontier is found with two partial aggregations,
so a topic holding a third of all pages is no bottleneck.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearsay.session import broadcast_if, local_frame
from hearsay.settings import Topic
from hearsay.sources.landing import hits_of, safe_topic


FACTS = ("topic", "page", "n_hits", "nb_pages")


def topic_frame(spark: SparkSession, topics: Sequence[Topic]) -> DataFrame:
    """Configured topics with their place in the list."""
    return local_frame(
        spark,
        {
            "topic": [t.name for t in topics],
            "query": [t.query or t.name for t in topics],
            "topic_order": list(range(len(topics))),
        },
        "topic string, query string, topic_order int",
    )


def named_pages(pages: DataFrame, topics: Sequence[Topic]) -> DataFrame:
    """Pages read from topic folders, under the names of the configured topics."""
    names = topic_frame(pages.sparkSession, topics).select(
        F.col("topic").alias("_name"), safe_topic(F.col("topic")).alias("topic")
    )
    joined = pages.join(broadcast_if(names, len(topics)), "topic")
    return joined.select(F.col("_name").alias("topic"), "page", "payload")


def frontier(
    facts: DataFrame, topics: DataFrame, n_topics: int, max_pages: int | None = None
) -> DataFrame:
    """Last accepted page per configured topic: `(topic, topic_order, last_page)`.

    Pages 0, 1, 2, ... are accepted up to a missing or corrupt page, up to and
    with an empty page or the last one the source has, and up to `max_pages`.
    Topics without an accepted page are left out.
    """
    readable = facts.filter("n_hits is not null")
    if max_pages is not None:
        readable = readable.filter(F.col("page") < max_pages)
    stops = (F.col("n_hits") == 0) | F.coalesce(F.col("page") + 1 >= F.col("nb_pages"), F.lit(False))
    # Every page marks itself as here and its successor as expected.
    marks = readable.select("topic", F.inline(F.array(
        F.struct(F.col("page").alias("page"), F.lit(True).alias("here"), stops.alias("stop")),
        F.struct((F.col("page") + 1).alias("page"), F.lit(False).alias("here"), F.lit(False).alias("stop")),
    )))
    pages = marks.groupBy("topic", "page").agg(
        F.max("here").alias("here"), F.max("stop").alias("stop")
    )
    ends = pages.groupBy("topic").agg(
        F.max(F.col("here") & (F.col("page") == 0)).alias("starts"),
        F.min(F.when(~F.col("here"), F.col("page"))).alias("first_gap"),
        F.min(F.when(F.col("stop"), F.col("page"))).alias("first_stop"),
    )
    known = ends.filter("starts").join(broadcast_if(topics, n_topics), "topic")
    return known.select(
        "topic", "topic_order", F.least(F.col("first_gap") - 1, F.col("first_stop")).alias("last_page")
    )


def accepted_pages(
    pages: DataFrame, topics: DataFrame, n_topics: int, max_pages: int | None = None
) -> DataFrame:
    """Rows of `pages` inside the accepted prefix of their topic."""
    ends = frontier(pages.select(*FACTS), topics, n_topics, max_pages)
    kept = pages.filter("n_hits is not null").join(broadcast_if(ends, n_topics), "topic")
    return kept.filter("page <= last_page").drop("last_page")


def explode_hits(pages: DataFrame) -> DataFrame:
    """One row per hit, in page order: `(topic, topic_order, page, pos, hit)`."""
    carried = [c for c in ("topic", "topic_order", "page") if c in pages.columns]
    return pages.select(*carried, F.posexplode(hits_of(F.col("payload"))).alias("pos", "hit"))


def capped_pages(
    pages: DataFrame, topics: DataFrame, n_topics: int, hits_per_page: int, cap: int | None
) -> DataFrame:
    """Accepted pages with `take`, the number of their first hits under the topic's cap.

    Where a topic reaches its cap is one row per topic. It is found by a running
    sum over page facts, at most ceil(cap / hits_per_page) rows per topic; hits
    and payloads are never sorted or shuffled.
    """
    if cap is None:
        return accepted_pages(pages, topics, n_topics).withColumn("take", F.col("n_hits"))
    facts, max_pages = pages.select(*FACTS), -(-cap // hits_per_page)
    earlier = Window.partitionBy("topic").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    running = accepted_pages(facts, topics, n_topics, max_pages).withColumn(
        "before", F.coalesce(F.sum("n_hits").over(earlier), F.lit(0))
    )
    full = running.filter((F.col("before") < cap) & (F.col("before") + F.col("n_hits") >= cap))
    cuts = full.select(
        "topic", F.col("page").alias("cut_page"), (F.lit(cap) - F.col("before")).alias("cut_take")
    )
    ends = frontier(facts, topics, n_topics, max_pages).join(
        broadcast_if(cuts, n_topics), "topic", "left"
    )
    kept = pages.filter("n_hits is not null").join(broadcast_if(ends, n_topics), "topic")
    kept = kept.filter(F.col("page") <= F.least("last_page", "cut_page"))
    take = F.when(F.col("page") == F.col("cut_page"), F.col("cut_take")).otherwise(F.col("n_hits"))
    return kept.withColumn("take", take).drop("last_page", "cut_page", "cut_take")


def advance(
    facts: DataFrame, state: DataFrame, n_topics: int, hits_per_page: int, cap: int | None
) -> DataFrame:
    """The pages that topics in `state(topic, topic_order, next_page, taken)` may read now, with `take`.

    As `capped_pages`, but each topic goes on from its `next_page`, after `taken`
    hits: of `facts` only pages from there on are looked at.
    """
    state = broadcast_if(state, n_topics)
    ahead = facts.join(state, "topic").filter(F.col("n_hits").isNotNull() & (F.col("page") >= F.col("next_page")))
    if cap is not None:
        ahead = ahead.filter(F.col("page") < -(-cap // hits_per_page))
    shifted = ahead.select(
        "topic", (F.col("page") - F.col("next_page")).alias("page"), "n_hits",
        (F.col("nb_pages") - F.col("next_page")).alias("nb_pages"),
    )
    ends = frontier(shifted, state.select("topic", "topic_order"), n_topics).select("topic", "last_page")
    kept = ahead.join(broadcast_if(ends, n_topics), "topic").filter(
        F.col("page") - F.col("next_page") <= F.col("last_page")
    )
    take = F.col("n_hits")
    if cap is not None:
        # At most ceil(cap / hits_per_page) pages of a topic are left here.
        earlier = Window.partitionBy("topic").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
        left = F.lit(cap) - F.col("taken") - F.coalesce(F.sum("n_hits").over(earlier), F.lit(0))
        kept = kept.withColumn("left", left).filter("left > 0")
        take = F.least(take, F.col("left").cast("int"))
    return kept.select("topic", "topic_order", "page", take.alias("take"), "n_hits", "nb_pages", "taken")


def paging_after(read: DataFrame) -> DataFrame:
    """Paging state `(topic, next_page, taken, ended)` of the topics of which `advance` gave pages."""
    last = (F.col("n_hits") == 0) | F.coalesce(F.col("page") + 1 >= F.col("nb_pages"), F.lit(False))
    return read.groupBy("topic").agg(
        (F.max("page") + 1).alias("next_page"), (F.max("taken") + F.sum("take")).alias("taken"),
        F.max(last).alias("ended"),
    )


class PageRun(NamedTuple):
    """Pages `low` to `high` of a topic that gives `hits` in all; of its page `last` only `last_take` are taken."""

    topic: str
    topic_order: int
    low: int
    high: int
    hits: int
    last: int
    last_take: int


def page_runs(chosen: DataFrame) -> list[PageRun]:
    """The pages that `advance` gave as one run per topic: they follow each other, and only the last may be cut."""
    runs = chosen.groupBy("topic", "topic_order").agg(
        F.min("page"), F.max("page"), F.sum("take"), F.max("page"), F.max_by("take", "page")
    )
    return [PageRun(*row) for row in runs.collect()]


def cut_runs(runs: Sequence[PageRun], slices: int) -> list[list[PageRun]]:
    """Runs cut into `slices` of about as many hits, the last in (topic order, page) first."""
    parts: list[list[PageRun]] = [[] for _ in range(slices)]
    total, before = sum(run.hits for run in runs), 0
    for run in sorted(runs, key=lambda r: (r.topic_order, r.topic)):
        pages, low = run.high - run.low + 1, run.low
        for part in range(slices):
            # The first page behind this slice: where hits, spread evenly over the run, pass its share.
            ahead = (part + 1) * total - slices * before
            end = run.low + -(-ahead * pages // (slices * run.hits)) if run.hits and part + 1 < slices else run.high + 1
            end = min(max(end, low), run.high + 1)
            if end > low:
                parts[part].append(run._replace(low=low, high=end - 1))
            low = end
        before += run.hits
    return parts[::-1]


def taken_hits(kept: DataFrame) -> DataFrame:
    """The first `take` hits of each page of `capped_pages`."""
    hits = kept.select(
        "topic", "topic_order", "page", "take",
        F.posexplode(hits_of(F.col("payload"))).alias("pos", "hit"),
    )
    return hits.filter("pos < take").drop("take")


def capped_hits(
    pages: DataFrame, topics: DataFrame, n_topics: int, hits_per_page: int, cap: int | None
) -> DataFrame:
    """The first `cap` hits per topic in (page, position) order; all if `cap` is None."""
    return taken_hits(capped_pages(pages, topics, n_topics, hits_per_page, cap))


def hits_per_topic(hits: DataFrame, topics: DataFrame) -> DataFrame:
    """Hit count of every configured topic, 0 for one with no readable page."""
    counts = hits.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    joined = topics.select("topic").join(counts, "topic", "left")
    return joined.select("topic", F.coalesce("n", F.lit(0)).alias("hits"))


def page_counters(ends: DataFrame) -> DataFrame:
    """Pages taken from the landing area, per topic and in total (topic null)."""
    counts = ends.rollup("topic").agg(F.sum(F.col("last_page") + 1).cast("bigint").alias("from_cache"))
    return counts.select("topic", F.lit(0).cast("bigint").alias("fetched"), F.coalesce("from_cache", F.lit(0)).alias("from_cache"))
