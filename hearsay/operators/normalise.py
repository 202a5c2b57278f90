"""Raw hit to typed record, or a reason why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.hits import coerce_int, field, kind, kind_name, truthy_text
from hearsay.functions.text import clean_text, empty_to_null, is_blank
from hearsay.functions.times import to_utc
from hearsay.session import settled
from hearsay.settings import DEFAULT_SOURCE, PERMALINK_PREFIX

# Fixed value: fields that must be present and not blank, in checking order.
REQUIRED_FIELDS = ("id", "topic", "text", "created_at")

RECORD_COLUMNS = (
    "id", "topic", "source", "author", "title", "text", "url", "created_at", "fetched_at",
    "points", "num_comments",
)
LABEL_COLUMNS = ("sentiment", "sentiment_score", "category")
ORDER_COLUMNS = ("topic_order", "page", "pos")


def choose_text(title: Column, story: Column, comment: Column) -> Column:
    """Cleaned title, else the cleaned body; null if both clean to nothing.

    The body is the story unless the raw story is empty, only then the comment.
    """
    body = clean_text(F.coalesce(F.nullif(story, F.lit("")), comment))
    return F.coalesce(empty_to_null(clean_text(title)), empty_to_null(body))


def default_url(url: Column, record_id: Column, prefix: str = PERMALINK_PREFIX) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(prefix), record_id))


def missing_field(record_id: Column, values: dict[str, Column]) -> Column:
    """Reason naming the first required field that is null or blank, else null."""
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in REQUIRED_FIELDS:
        value = values[name]
        bad = is_blank(value.cast("string"))
        shown = F.coalesce(F.concat(F.lit("'"), record_id, F.lit("'")), F.lit("None"))
        reason = reason.when(
            bad, F.concat(F.lit("Record "), shown, F.lit(f" missing required field '{name}'"))
        )
    return reason


def payload_hash(topic: Column, payload: Column) -> Column:
    """Quarantine key: digest of topic and the whole payload."""
    return F.sha2(F.concat_ws("|", topic, payload), 256)


def assess_hits(
    hits: DataFrame,
    fetched_at: Column,
    source: str = DEFAULT_SOURCE,
    permalink_prefix: str = PERMALINK_PREFIX,
) -> DataFrame:
    """Hits `(topic, topic_order, page, pos, hit)` with record columns and `reason`.

    `reason` is null for a valid record. Checks run in a fixed order and the
    first failure wins. `raw_id` and `payload` (whole, as compact JSON) keep what a
    rejected hit looked like.
    """
    hit = F.col("hit")
    carried = ["topic", *ORDER_COLUMNS]
    wide = hits.select(
        *carried,
        "hit",
        kind(hit).alias("_kind"),
        truthy_text(hit, "objectID").alias("id"),
        truthy_text(hit, "title").alias("_title"),
        kind(field(hit, "title", "variant")).alias("_title_kind"),
        F.coalesce(truthy_text(hit, "story_text"), truthy_text(hit, "comment_text")).alias("_body"),
    )
    cleaned = wide.select(
        *carried, "hit", "_kind", "id", "_title", "_title_kind",
        empty_to_null(clean_text(F.col("_title"))).alias("title"),
        F.col("_body"),
    )
    epoch = coerce_int(hit, "created_at_i")
    written = F.when(
        kind(field(hit, "created_at", "variant")) == "STRING", field(hit, "created_at")
    )
    typed = cleaned.select(
        *carried, "hit", "_kind", "id", "title",
        (F.col("_title").isNotNull() & (F.col("_title_kind") != "STRING")).alias("_odd_title"),
        F.when(F.col("title").isNotNull(), F.col("title"))
        .otherwise(empty_to_null(clean_text(F.col("_body")))).alias("text"),
        to_utc(epoch, written).alias("created_at"),
    )

    def hit_reason(tail: str) -> Column:
        return F.concat(F.lit("Hit "), F.col("id"), F.lit(tail))

    # Wording of the reject reasons, in checking order.
    reason = (
        F.when(
            F.col("_kind") != "OBJECT",
            F.concat(F.lit("Expected a dict hit, got "), kind_name(hit)),
        )
        .when(F.col("id").isNull(), "Hit has no objectID; cannot assign a stable key.")
        .when(F.col("_odd_title"), hit_reason(" has a title that is not text."))
        .when(F.col("text").isNull(), hit_reason(" has neither title nor text."))
        .when(
            F.col("created_at").isNull(), hit_reason(" has no parseable creation timestamp.")
        )
        .otherwise(missing_field(
            F.col("id"), {name: F.col(name) for name in REQUIRED_FIELDS}
        ))
    )
    raw_id = F.when(F.col("_kind") == "OBJECT", field(hit, "objectID"))
    rejected = F.col("reason").isNotNull()
    judged = typed.withColumn("reason", reason)
    return settled(
        judged,
        F.col("id"), F.col("topic"),
        F.lit(source).alias("source"),
        truthy_text(hit, "author").alias("author"),
        F.col("title"), F.col("text"),
        default_url(truthy_text(hit, "url"), F.col("id"), permalink_prefix).alias("url"),
        F.col("created_at"),
        fetched_at.alias("fetched_at"),
        coerce_int(hit, "points").alias("points"),
        coerce_int(hit, "num_comments").alias("num_comments"),
        *[F.col(c) for c in ORDER_COLUMNS],
        F.col("reason"),
        F.when(rejected, raw_id).alias("raw_id"),
        F.when(rejected, F.to_json(hit)).alias("payload"),
    )


def valid_records(assessed: DataFrame) -> DataFrame:
    """The records, with label columns still null and their place in the batch."""
    empty = [
        F.lit(None).cast("string").alias("sentiment"),
        F.lit(None).cast("double").alias("sentiment_score"),
        F.lit(None).cast("string").alias("category"),
    ]
    return assessed.filter("reason is null").select(*RECORD_COLUMNS, *empty, *ORDER_COLUMNS)


def rejected_hits(assessed: DataFrame) -> DataFrame:
    """Quarantine rows with their place in the batch; the payload is compact JSON."""
    return assessed.filter("reason is not null").select(
        payload_hash(F.col("topic"), F.col("payload")).alias("payload_hash"),
        "topic", *ORDER_COLUMNS, "raw_id", "reason", "payload",
        F.col("fetched_at").alias("recorded_at"),
    )
