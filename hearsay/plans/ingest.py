"""One run: accepted pages to records, quarantine, labels and counters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.operators.labelling import label_records, label_rows
from hearsay.operators.normalise import (
    ORDER_COLUMNS, RECORD_COLUMNS, assess_hits, rejected_hits,
)
from hearsay.operators.pages import capped_hits, frontier, topic_frame
from hearsay.operators.report_state import relabelled
from hearsay.operators.runs import COUNTERS
from hearsay.operators.upsert import first_per_payload, insert_or_ignore, last_per_id
from hearsay.session import let_go, staging
from hearsay.settings import RunSettings
from hearsay.sources.landing import read_landing
from hearsay.sources.store import MentionStore

# What the counts of the report states are made from.
CELL = ("topic", "category", "sentiment", "sentiment_score")


def batch_hits(spark: SparkSession, pages: DataFrame, settings: RunSettings) -> DataFrame:
    """The hits one run offers: accepted pages of configured topics, capped per topic."""
    topics = topic_frame(spark, settings.topics)
    return capped_hits(
        pages, topics, len(settings.topics), settings.hits_per_page, settings.max_items_per_topic
    )


def step_counters(assessed: DataFrame, stored: DataFrame) -> DataFrame:
    """Normalised, quarantined, inserted and duplicate counts of assessed hits, as one row.

    Hits are read once: valid ones are counted per id, which also gives the
    number of unique ids; rejects fall into the group without id.
    """
    per_id = assessed.select(F.when(F.col("reason").isNull(), F.col("id")).alias("id")).groupBy(
        "id"
    ).agg(F.count(F.lit(1)).alias("n"))
    known = stored.select("id", F.lit(True).alias("known"))
    valid, zero = F.col("id").isNotNull(), F.lit(0).cast("bigint")
    return per_id.join(known, "id", "left").agg(
        F.coalesce(F.sum(F.when(valid, F.col("n"))), zero).alias("normalised"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), zero).alias("quarantined"),
        F.count_if(valid & F.col("known").isNull()).alias("inserted"),
        F.count_if(valid & F.col("known").isNotNull()).alias("duplicates"),
    )


def batch_counters(
    spark: SparkSession, pages: DataFrame, stored: DataFrame, settings: RunSettings, at: datetime
) -> DataFrame:
    """The counters a run over `pages` would give, as one row, without writing."""
    topics = topic_frame(spark, settings.topics)
    assessed = assess_hits(
        batch_hits(spark, pages, settings), F.lit(at), settings.source, settings.permalink_prefix
    )
    counted = step_counters(assessed, stored).withColumn("classified", F.col("inserted"))
    missing = F.col("sentiment").isNull() | F.col("category").isNull()
    pending = stored.agg(F.count_if(missing).alias("classified"))
    facts = pages.select("topic", "page", "n_hits", "nb_pages")
    ends = frontier(facts, topics, len(settings.topics), settings.max_pages)
    cached = ends.agg(F.sum(F.col("last_page") + 1).alias("from_cache"))
    parts = counted.unionByName(pending, True).unionByName(cached, True)
    zero = F.lit(0).cast("bigint")
    return parts.withColumn("fetched", zero).agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in COUNTERS]
    )


def ingest_hits(
    hits: DataFrame, store: MentionStore, settings: RunSettings, at: datetime
) -> dict[str, int]:
    """Load hits into the store and return the counters of the steps."""
    return ingest_slices([hits], store, settings, at)


def ingest_slices(
    slices: Iterable[DataFrame], store: MentionStore, settings: RunSettings, at: datetime
) -> dict[str, int]:
    """Load a batch of hits, given in slices, into the store and return the counters of the steps.

    The slice that is last in (topic order, page) comes first: of an id in several
    of them the last record is stored, as within a slice, and the others are known.
    Each slice stages its assessed hits, and its new mentions with their labels:
    later steps read those tables instead of computing again, and a lost executor
    costs no more than its own tasks. They go with the slice; keys of all hits and
    payloads of the rejected ones stay to the end, for counters and quarantine.
    Every write to the store skips what is stored, so a run that failed half way is
    repaired by running it again. Texts of stored mentions are not read.
    """
    spark = store.spark
    with staging(spark) as written:
        assessed, inserted = None, 0
        for hits in slices:
            keys, n = _ingest_slice(hits, store, settings, at, written)
            let_go(spark)
            assessed, inserted = keys if assessed is None else assessed.unionByName(keys), inserted + n
        late = _label_late(store, settings, at)

        # What this run inserted is stored by now.
        counters = step_counters(assessed, store.table("mentions_base")).first().asDict()
        known = counters["inserted"] + counters["duplicates"] - inserted
        rejects = first_per_payload(rejected_hits(assessed))
        store.append(insert_or_ignore(rejects, store.quarantine(), "payload_hash"), "quarantine")
    return counters | {"inserted": inserted, "duplicates": known, "classified": inserted + late}


def _ingest_slice(
    hits: DataFrame, store: MentionStore, settings: RunSettings, at: datetime,
    kept: Callable[[DataFrame, str], DataFrame],
) -> tuple[DataFrame, int]:
    """Store and label what is new in a slice: its assessed hits without texts, `kept` as a table, and how many are new."""
    stamp = F.lit(at).cast("timestamp")
    assessed = assess_hits(hits, stamp, settings.source, settings.permalink_prefix)
    with staging(store.spark) as written:
        staged = written(assessed, "staged-hits")
        batch = last_per_id(staged.filter("reason is null").select(*RECORD_COLUMNS, *ORDER_COLUMNS))
        fresh = insert_or_ignore(batch, store.table("mentions_base"), "id")
        fresh = written(label_records(fresh, settings), "new-mentions")
        report = uuid.uuid4().hex
        store.open_batch(report)
        store.append(fresh, "mentions_base")
        store.append(fresh.withColumn("labelled_at", stamp), "mention_labels")
        came = fresh.select(*CELL)
        store.close_batch(report, came, came.limit(0), fresh)
        keys = kept(staged.select(
            "id", "topic", *ORDER_COLUMNS, "reason", "raw_id", "payload", "fetched_at"
        ), "assessed-keys")
        return keys, fresh.count()


def _label_late(store: MentionStore, settings: RunSettings, at: datetime) -> int:
    """Label rows that an earlier run stored but did not label, usually none; their number."""
    left = store.unlabelled_ids()
    late = left.count()
    if late:
        with staging(store.spark) as written:
            report = uuid.uuid4().hex
            store.open_batch(report)
            open_rows = store.table("mentions_base").join(left, "id", "left_semi")
            labels = label_rows(open_rows, settings).withColumn("labelled_at", F.lit(at).cast("timestamp"))
            labels = written(labels, "late-labels")
            before = store.mentions().join(labels.select("id"), "id", "left_semi").select("id", *CELL)
            came, went = relabelled(written(before, "before"), labels)
            store.append(labels, "mention_labels")
            store.close_batch(report, came, went, store.mentions().limit(0))
    return late


def run(
    spark: SparkSession, landing: str, store: MentionStore, settings: RunSettings,
    run_id: str, started_at: datetime, finished_at: datetime | None = None,
) -> dict[str, int]:
    """A full run over all landed pages, logged in the run log."""
    store.log_event(run_id, "start", started_at)
    pages = read_landing(spark, landing)
    topics = topic_frame(spark, settings.topics)
    facts = pages.select("topic", "page", "n_hits", "nb_pages")
    ends = frontier(facts, topics, len(settings.topics), settings.max_pages)
    cached = ends.agg(F.coalesce(F.sum(F.col("last_page") + 1), F.lit(0)).alias("n")).first()["n"]
    counters = ingest_hits(batch_hits(spark, pages, settings), store, settings, started_at)
    counters |= {"fetched": 0, "from_cache": cached}
    store.log_event(run_id, "finish", finished_at or datetime.now().astimezone(), counters)
    return counters
