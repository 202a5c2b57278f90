"""The mention store: append-only Parquet tables, bucketed on their keys.

Mentions and labels are bucketed on `id`, the quarantine on `payload_hash`, so
the anti joins that keep writes free of duplicates, and the join of mentions
with their labels, read the stored side without shuffling it. Only the batch
moves. Nothing is updated in place.

Every append leaves one file per bucket. `compact` writes a bucketed table anew
with one file per bucket, in a folder of its own that counts from the moment its
number is written; whoever opened the store before reads the old folder on.

Reports come from mergeable states that each run adds (`operators.report_state`).
A run opens its batch before it writes and closes it behind its states; after a
run that did not get so far the states are made anew from the tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.operators import report_state
from hearsay.operators.normalise import RECORD_COLUMNS
from hearsay.operators.runs import COUNTERS, EVENT_SCHEMA, run_log
from hearsay.session import COMPRESSION, staging

TABLES: dict[str, tuple[str, str | None]] = {
    "mentions_base": (
        "id string, topic string, source string, author string, title string, text string, "
        "url string, created_at timestamp, fetched_at timestamp, points bigint, num_comments bigint",
        "id",
    ),
    "mention_labels": (
        "id string, sentiment string, sentiment_score double, category string, "
        "matched_term string, labelled_at timestamp",
        "id",
    ),
    "quarantine": (
        "payload_hash string, raw_id string, topic string, reason string, payload string, "
        "recorded_at timestamp",
        "payload_hash",
    ),
    "run_events": (EVENT_SCHEMA, None),
    "report_counts": (report_state.COUNTS_SCHEMA, None),
    "report_items": (report_state.ITEMS_SCHEMA, None),
    "report_batches": ("batch string, event string", None),
    "paging": ("topic string, next_page int, taken bigint, ended boolean", None),
}
COUNTABLE = ("mentions", "quarantine", "run_log")


class MentionStore:
    """Tables of one store, kept in `folder` and registered as database `name`.

    The number of buckets is fixed when the tables are made and kept in the
    folder, so any later session reads the files as they were written. It should
    not be below the shuffle partitions, whose number is the default: then joins
    bring the batch to the buckets, never the stored rows to the batch.
    """

    def __init__(
        self, spark: SparkSession, name: str, folder: str, buckets: int | None = None
    ) -> None:
        self.spark = spark
        self.name = name
        self.folder = folder
        self.buckets = buckets = self._layout(buckets)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
        for table in TABLES:
            self._create(table, table, self._version(table))

    def _path(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _version(self, table: str) -> int:
        """How often the table was compacted: the highest number that was written for it."""
        target, files = self._path(f"{self.folder}/_versions/{table}")
        if not files.exists(target):
            return 0
        return max((int(f.getPath().getName()) for f in files.listStatus(target)), default=0)

    def _create(self, name: str, table: str, version: int) -> None:
        schema, key = TABLES[table]
        cluster = f"CLUSTERED BY ({key}) INTO {self.buckets} BUCKETS" if key else ""
        place = f"{self.folder}/{table}" + (f".{version}" if version else "")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name}.{name} ({schema}) USING parquet "
            f"OPTIONS (compression '{COMPRESSION}') {cluster} LOCATION '{place}'"
        )

    def compact(self, table: str, delete_old: bool = False) -> int:
        """Rewrite a bucketed table with one file per bucket; the number of its rows.

        Of rows that share a key one stays, of labels the last: so far as readers can
        tell nothing changes. Writers must not append meanwhile. A compaction that
        did not end left a folder without a number, which the next one writes anew.
        """
        schema, key = TABLES[table]
        if not key:
            raise ValueError(f"{table} has no key and is not bucketed")
        columns = [c.strip().split(" ")[0] for c in schema.split(",")]
        rows = self.table(table)
        rest = F.struct(*[c for c in columns if c != key])
        last = F.max_by(rest, "labelled_at") if "labelled_at" in columns else F.first(rest)
        one = rows.groupBy(key).agg(last.alias("_rest")).select(
            *[F.col(key) if c == key else F.col(f"_rest.{c}").alias(c) for c in columns]
        )
        keys = rows.agg(F.count_distinct(key)).first()[0]

        version, old = self._version(table) + 1, self._version(table)
        fresh = f"{table}_{version}"
        target, files = self._path(f"{self.folder}/{table}.{version}")
        files.delete(target, True)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}.{fresh}")
        self._create(fresh, table, version)
        one.repartition(self.buckets, key).sortWithinPartitions(key).write.insertInto(f"{self.name}.{fresh}")
        written = self.spark.table(f"{self.name}.{fresh}").agg(F.count(F.lit(1)), F.count_distinct(key)).first()
        if tuple(written) != (keys, keys):
            raise RuntimeError(f"{table} has {keys} keys, its copy {written[0]} rows with {written[1]}")
        # From here on the copy counts: creating a file is one step.
        mark, files = self._path(f"{self.folder}/_versions/{table}/{version}")
        files.create(mark, False).close()
        for name in (fresh, table):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}.{name}")
        self._create(table, table, version)
        if delete_old:
            target, files = self._path(f"{self.folder}/{table}" + (f".{old}" if old else ""))
            files.delete(target, True)
        return keys

    def _layout(self, wanted: int | None) -> int:
        """The store's bucket count: read if the store exists, else written once."""
        path = f"{self.folder}/_layout"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            kept = self.spark.read.schema("buckets int").json(path).first()["buckets"]
            if wanted not in (None, kept):
                raise ValueError(f"the store in {self.folder} has {kept} buckets, not {wanted}")
            return kept
        buckets = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.range(1).selectExpr(f"{buckets} as buckets").write.json(path)
        return buckets

    def table(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.name}.{table}")

    def append(self, rows: DataFrame, table: str) -> None:
        """Append rows; a bucketed table gets one file per bucket."""
        schema, key = TABLES[table]
        columns = [c.strip().split(" ")[0] for c in schema.replace("(38,12)", "").split(",")]
        chosen = rows.select(*columns)
        if key:
            chosen = chosen.repartition(self.buckets, key)
        chosen.write.insertInto(f"{self.name}.{table}")

    def save_paging(self, moved: DataFrame) -> None:
        """Keep the paging state of topics that moved on; one row per topic.

        A state that is lost on the way costs reading those topics from their first
        page again, which stores nothing twice.
        """
        rest = self.table("paging").join(moved.select("topic"), "topic", "left_anti")
        names = ["topic", "next_page", "taken", "ended"]
        with staging(self.spark) as written:
            whole = written(rest.select(*names).unionByName(moved.select(*names)).coalesce(1), "paging-state")
            whole.write.insertInto(f"{self.name}.paging", overwrite=True)

    def labels(self) -> DataFrame:
        """The latest label of each id."""
        columns = ("sentiment", "sentiment_score", "category", "matched_term")
        latest = self.table("mention_labels").groupBy("id").agg(
            F.max_by(F.struct(*columns), "labelled_at").alias("l")
        )
        return latest.select("id", *[F.col(f"l.{c}").alias(c) for c in columns])

    def mentions(self) -> DataFrame:
        """All 14 columns; label columns are null until a row is labelled."""
        joined = self.table("mentions_base").join(self.labels(), "id", "left")
        return joined.select(*RECORD_COLUMNS, "sentiment", "sentiment_score", "category")

    def unlabelled_ids(self) -> DataFrame:
        """Ids still missing a label; reads ids and label columns only."""
        done = self.labels().filter("sentiment is not null and category is not null")
        return self.table("mentions_base").select("id").join(done, "id", "left_anti")

    def quarantine(self) -> DataFrame:
        return self.table("quarantine")

    def run_log(self) -> DataFrame:
        return run_log(self.table("run_events"))

    def open_batch(self, batch: str) -> None:
        """Say that a run is about to write."""
        self._log_batch(batch, "open")

    def close_batch(self, batch: str, came: DataFrame, went: DataFrame, items: DataFrame) -> None:
        """Add a run's report states: mentions as they are now, those of them as they were, and its best items."""
        if self._unfinished([batch]):
            self.rebuild_report()
        else:
            self.append(report_state.count_changes(came, went), "report_counts")
            self.append(report_state.best_items(items), "report_items")
        self._log_batch(batch, "done")

    def _log_batch(self, batch: str, event: str) -> None:
        row = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(event).alias("event"))
        self.append(row, "report_batches")

    def _unfinished(self, known: list[str]) -> bool:
        """Whether a run other than the `known` ones opened a batch and did not close it."""
        events = self.table("report_batches").where(~F.col("batch").isin(known))
        ended = events.groupBy("batch").agg(F.max(F.col("event") == "done").alias("done"))
        return not ended.where("not done").isEmpty()

    def rebuild_report(self) -> None:
        """Make the report states anew from the tables, and count all batches as done."""
        rows = self.mentions()
        for table, state in (("report_counts", report_state.count_changes(rows)), ("report_items", report_state.best_items(rows))):
            names = [c.strip().split(" ")[0] for c in TABLES[table][0].replace("(38,12)", "").split(",")]
            state.select(*names).write.insertInto(f"{self.name}.{table}", overwrite=True)
        left = self.table("report_batches").groupBy("batch").agg(F.max(F.col("event") == "done").alias("done"))
        for (batch,) in left.where("not done").select("batch").collect():
            self._log_batch(batch, "done")

    def report(self, k: int = 3) -> dict[str, DataFrame]:
        """Sections of the summary, from the states: no mention is read."""
        counts = report_state.merge_counts(self.table("report_counts"))
        quarantined = self.count("quarantine").first()["n"]
        return {
            "headline": report_state.headline_counts(counts, quarantined),
            "sentiment_by_topic": report_state.sentiment_by_topic(counts),
            "category_distribution": report_state.category_distribution(counts),
            "topics": report_state.distinct_topics(counts),
            "top_items": report_state.top_items(self.table("report_items"), self.labels(), k),
        }

    def count(self, table: str = "mentions") -> DataFrame:
        return table_counts({table: self._countable(table)})

    def _countable(self, table: str) -> DataFrame:
        if table not in COUNTABLE:
            raise ValueError(f"unknown table {table!r}")
        if table == "mentions":
            return self.table("mentions_base")
        return self.quarantine() if table == "quarantine" else self.run_log()

    def log_event(
        self, run_id: str, event: str, at: datetime, counters: dict[str, int] | None = None
    ) -> None:
        """Append a start or finish event."""
        values = counters or {}
        row = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.lit(event).alias("event"),
            F.lit(at).cast("timestamp").alias("at"),
            F.lit(0 if event == "start" else 1).cast("bigint").alias("seq"),
            *[F.lit(values.get(c, 0)).cast("bigint").alias(c) for c in COUNTERS],
        )
        self.append(row, "run_events")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table; only the store's own tables can be counted."""
    counts = None
    for name, frame in tables.items():
        if name not in COUNTABLE:
            raise ValueError(f"unknown table {name!r}")
        one = frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts
