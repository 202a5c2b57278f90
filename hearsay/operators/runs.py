"""Run log: append-only start and finish events, and the views on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.functions.text import truncate
from hearsay.settings import RUN_TIME_CHARS

COUNTERS = (
    "fetched", "from_cache", "normalised", "quarantined", "inserted", "duplicates", "classified",
)
EVENT_SCHEMA = (
    "run_id string, event string, at timestamp, seq bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTERS)
)


def run_log(events: DataFrame) -> DataFrame:
    """One row per started run.

    A start replaces the row (no finish, counters 0); a finish fills it. So a
    run is finished when its latest event is a finish. A finish of a run that
    never started changes nothing.
    """
    order = F.struct("at", "seq")
    is_start = F.col("event") == "start"
    latest = events.groupBy("run_id").agg(
        F.max_by(F.struct("event", "at", *COUNTERS), order).alias("last"),
        F.max(F.when(is_start, order)).alias("begun"),
    ).filter("begun is not null")
    done = F.col("last.event") == "finish"
    return latest.select(
        "run_id",
        F.col("begun.at").alias("started_at"),
        F.when(done, F.col("last.at")).alias("finished_at"),
        *[F.coalesce(F.when(done, F.col(f"last.{c}")), F.lit(0)).alias(c) for c in COUNTERS],
    )


def run_history(log: DataFrame, last: int = 5) -> DataFrame:
    """The latest completed runs, newest first."""
    done = log.filter("finished_at is not null")
    shown = done.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(last)
    started = F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return shown.select(
        truncate(started, RUN_TIME_CHARS).alias("run_started"), "run_id", *COUNTERS
    )
