"""Incremental ingest as two Structured Streaming jobs over files.

`land_stream` turns newly arrived JSON files into rows of the landing table.
`ingest_stream` reads new rows of the landing table and loads what they make
acceptable. State lives in the tables, not in the stream, so a replayed batch
changes nothing and a lost executor or driver is repaired by starting again.

The state of paging is one row per topic: the page to go on with, the hits taken,
and whether the source has ended. A batch looks at the topics it touches, from
that page on; what was loaded before is not read again, however long it is. Pages
behind a gap wait in the landing table until the missing one arrives. A higher
cap takes effect with the next page.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearsay.operators.pages import (
    FACTS, PageRun, advance, cut_runs, named_pages, page_runs, paging_after, taken_hits, topic_frame,
)
from hearsay.plans.ingest import ingest_slices
from hearsay.session import broadcast_if, let_go, staging
from hearsay.settings import RunSettings, Topic
from hearsay.sources.landing import LANDING_SCHEMA, land, page_of_path, read_landing, topic_of_path
from hearsay.sources.store import MentionStore

# A batch is loaded in slices of about SLICE_HITS hits, at most SLICES: only a slice's texts are staged and shuffled at once.
SLICE_HITS, SLICES = 25_000, 8


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)


def _start(
    frame: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    writer = frame.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def land_stream(
    spark: SparkSession, json_folder: str, landing: str, topics: Sequence[Topic],
    checkpoint: str, max_files: int | None = None,
) -> StreamingQuery:
    """Land every new `<topic>/page_NNN.json` of the configured topics, then stop."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(f"{json_folder}/*/")
    path = F.col("_metadata.file_path")
    pages = files.select(
        topic_of_path(path).alias("topic"), page_of_path(path).alias("page"),
        F.col("value").alias("payload"),
    ).filter("page is not null")

    def step(batch: DataFrame, _: int) -> None:
        land(batch.sparkSession, named_pages(batch, topics), landing)

    return _start(pages, step, checkpoint)


def ingest_stream(
    spark: SparkSession, landing: str, store: MentionStore, settings: RunSettings,
    checkpoint: str, clock: Callable[[], datetime] = _utc_now, max_files: int | None = None,
) -> StreamingQuery:
    """Load newly landed pages, and older ones they unblock, then stop.

    A landing area where nothing was landed yet gives no rows.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(landing)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrivals = reader.parquet(landing).select("topic", "page")

    def step(batch: DataFrame, _: int) -> None:
        ingest_arrivals(batch, landing, store, settings, clock())

    return _start(arrivals, step, checkpoint)


def ingest_arrivals(
    arrivals: DataFrame, landing: str, store: MentionStore, settings: RunSettings, at: datetime
) -> dict[str, int]:
    """Load what the topics that got new pages may read from where they stand.

    Paging is decided on page facts, and the open pages are written as a small
    table of keys; only then are payloads read, slice by slice of many pages. The
    state of paging is kept last.
    """
    spark = store.spark
    n_topics, cap = len(settings.topics), settings.max_items_per_topic
    touched = topic_frame(spark, settings.topics).join(
        arrivals.select("topic").distinct(), "topic", "left_semi"
    )
    known = touched.join(store.table("paging"), "topic", "left").select(
        "topic", "topic_order", F.coalesce("next_page", F.lit(0)).alias("next_page"),
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), F.coalesce("ended", F.lit(False)).alias("ended"),
    )
    pages = read_landing(spark, landing)
    with staging(spark) as written:
        state = written(known.filter("not ended"), "paging")
        low = state.agg(F.min("next_page")).first()[0]
        facts = pages.select(*FACTS).filter(F.col("page") >= F.lit(low))
        chosen = written(advance(facts, state, n_topics, settings.hits_per_page, cap), "open-pages")
        runs = page_runs(chosen)
        slices = min(SLICES, max(1, -(-sum(run.hits for run in runs) // SLICE_HITS)))
        parts = (taken_hits(_payloads(pages, part)) for part in cut_runs(runs, slices))
        counters = ingest_slices(parts, store, settings, at)
        store.save_paging(paging_after(chosen))
    let_go(spark)
    return counters


def with_payload(pages: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen pages `(topic, topic_order, page, take)` with their payloads."""
    return _payloads(pages, page_runs(chosen))


def _payloads(pages: DataFrame, runs: Sequence[PageRun]) -> DataFrame:
    """The pages of the runs, with their payloads and the number of hits to `take`.

    There is one run per topic, however many its pages, so runs are broadcast and
    payloads stay where they are. Topic folders without an open page are not read;
    page bounds skip the files of a topic that hold older pages alone.
    """
    low, high = min((r.low for r in runs), default=None), max((r.high for r in runs), default=None)
    readable = pages.filter(F.col("n_hits").isNotNull() & F.col("page").between(F.lit(low), F.lit(high)))
    schema = "topic string, topic_order int, low int, high int, hits bigint, last int, last_take int"
    bounds = pages.sparkSession.createDataFrame(list(runs), schema).drop("hits")
    # All runs pass the filter; where there is one, Spark prunes the folders by the topics that are left.
    bounds = broadcast_if(bounds.filter(F.col("high") >= F.lit(low)), len(runs))
    found = readable.select("topic", "page", "payload", "n_hits").join(bounds, "topic").filter(
        F.col("page").between(F.col("low"), F.col("high"))
    )
    take = F.when(F.col("page") == F.col("last"), F.col("last_take")).otherwise(F.col("n_hits"))
    return found.select("topic", "page", "payload", "topic_order", take.alias("take"))
