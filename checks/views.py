"""Test views over the given tables: a mention store, raw hits and pages, gold labels, runs.

Each view covers its whole table. Topics, pages and defects follow from the
document number by arithmetic, so building hits needs no shuffle; one topic
(`hot`) holds a third of the first listing.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.operators.pages import topic_frame
from hearsay.session import spread, use_utc
from hearsay.settings import RunSettings, SentimentRules, Topic
from hearsay.sources.landing import with_page_facts

FETCHED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
FIRST_SECOND = 1704067200  # 2024-01-01T00:00:00Z
PAGE_SIZE = 20
# Document numbers after which pages of all topics end: PAGE_SIZE times 3, 15 and 4 numbers make a page.
RUN = 60 * PAGE_SIZE
CAP = 50

TOPICS = (
    Topic("hot"), *(Topic(f"s{i}") for i in range(10)), *(Topic(f"tag{i}") for i in range(4)),
    Topic("nohits"),
)

# Small rule table and lexicon of words that the documents hold.
RULES = [
    ("release", [r"\breleased?\b", r"\bv?\d+\.\d+\b"]),
    ("spanish", [r"\bde los\b", r"\bel\b"]),
    ("technical", [r"\btoken(?:s)?\b", r"\bouth\w*\b"]),
    ("french", [r"\bles?\b", r"\bet\b"]),
    ("english", [r"\bthat\b", r"\bfrom\b"]),
]
LEXICON = {
    "the": 0.6, "of": -0.4, "that": 1.9, "la": 1.2, "es": -1.5, "le": 0.8, "de": -0.3,
    "released": 1.5, "token": -0.7, "und": 0.9, "die": -1.1, "is": 0.7, "no": -1.2, "que": -0.2,
}
WORDS = SentimentRules(
    stronger=("to", "der", "des", "by"), weaker=("in", "les", "den"),
    negations=("and", "et", "von", "never", "without"), contrast="with",
    idioms=(("of the", 2.0), ("que la", -1.0)),
)


def settings(cap: int | None = None) -> RunSettings:
    return RunSettings(
        topics=TOPICS, source="documents", hits_per_page=PAGE_SIZE, max_items_per_topic=cap,
        rules=RULES, categories=tuple(name for name, _ in RULES),
        lexicon=LEXICON, sentiment_rules=WORDS,
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, split over all cores for costly text work."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of labelled mentions, some rows still without one or both labels."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    score = F.when(doc % 17 != 0, (F.col("n_chars") % 201 - 100) / 100.0)
    return d.select(
        doc.cast("string").alias("id"),
        F.col("source").alias("topic"),
        F.lit("documents").alias("source"),
        F.col("lang").alias("author"),
        F.when(doc % 4 == 0, F.concat(F.lit("Item "), doc.cast("string"))).when(doc % 4 == 1, "").alias("title"),
        "text",
        F.concat(F.lit("https://example.org/item/"), doc.cast("string")).alias("url"),
        F.timestamp_seconds(FIRST_SECOND + F.expr("doc_id div 40") * 3600).alias("created_at"),
        F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"),
        F.when(doc % 10 != 0, F.col("n_chars")).alias("points"),
        F.lit(None).cast("bigint").alias("num_comments"),
        F.when(score >= 0.05, "positive").when(score <= -0.05, "negative")
        .when(score.isNotNull(), "neutral").alias("sentiment"),
        score.alias("sentiment_score"),
        F.when((doc % 17 != 0) & (doc % 29 != 0), F.concat(F.lit("cat"), (F.col("n_chars") % 5).cast("string"))).alias("category"),
    )


def _hit_json(doc: Column) -> Column:
    """One raw hit of a document, with defects by document number."""
    text = F.col("text")
    bare = doc % 19 == 0
    rest = F.to_json(F.struct(
        F.when(bare, F.lit(None)).when(doc % 4 == 0, text).when(doc % 4 == 3, "").alias("title"),
        F.when(bare, "<p></p>").when(doc % 4 == 1, text)
        .when(doc % 4 == 3, F.concat(F.lit("<p>"), text, F.lit(" &amp; more</p>"))).alias("story_text"),
        F.when(bare | (doc % 4 == 2), text).alias("comment_text"),
        F.when(doc % 7 == 0, "").otherwise(F.col("lang")).alias("author"),
        F.when(doc % 5 == 1, "").when(doc % 5 != 0, F.concat(F.lit("https://example.org/"), doc.cast("string"))).alias("url"),
        F.when((doc % 23 != 0) & (doc % 31 != 0), FIRST_SECOND + doc * 60).alias("created_at_i"),
        F.when(
            doc % 31 == 0,
            F.date_format(F.timestamp_seconds(FIRST_SECOND + doc * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        ).alias("created_at"),
        F.when(doc % 6 == 0, "n/a").otherwise(F.col("n_chars").cast("string")).alias("points"),
        (doc % 50 + 0.5).alias("num_comments"),
    ))
    quote = F.when(doc % 4 == 1, "").otherwise('"')
    key = F.when(doc % 13 == 0, "{").otherwise(
        F.concat(F.lit('{"objectID":'), quote, doc.cast("string"), quote, F.lit(","))
    )
    return F.when(doc % 101 == 0, doc.cast("string")).otherwise(
        F.concat(key, F.substring(rest, 2, 2**31 - 1))
    )


def _page(rank: Column) -> Column:
    return ((rank - rank % PAGE_SIZE) / PAGE_SIZE).cast("int")


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under two topics: `(doc_id, json, topic, topic_order, page, pos)`."""
    return _listed(texts(spark, sf_dir))


def _listed(docs: DataFrame, *carried: str) -> DataFrame:
    doc = F.col("doc_id")
    rest = F.expr("doc_id div 3") * 2 + doc % 3 - 1
    first_rank = F.when(doc % 3 == 0, F.expr("doc_id div 3")).otherwise(((rest - rest % 10) / 10).cast("bigint"))
    first = F.struct(
        F.when(doc % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (rest % 10).cast("string"))).alias("topic"),
        F.when(doc % 3 == 0, 0).otherwise(1 + rest % 10).cast("int").alias("topic_order"),
        _page(first_rank).alias("page"),
        (first_rank % PAGE_SIZE).cast("int").alias("pos"),
    )
    second_rank = F.expr("doc_id div 4")
    second = F.struct(
        F.concat(F.lit("tag"), (doc % 4).cast("string")).alias("topic"),
        (11 + doc % 4).cast("int").alias("topic_order"),
        _page(second_rank).alias("page"),
        (second_rank % PAGE_SIZE).cast("int").alias("pos"),
    )
    d = docs.withColumn("json", _hit_json(doc))
    return d.select(*carried, "doc_id", "json", F.inline(F.array(first, second)))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hits as if every page had been read."""
    return listed(spark, sf_dir).select(
        "topic", "topic_order", "page", "pos", F.parse_json("json").alias("hit")
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages of at most PAGE_SIZE hits, with a gap, a corrupt, an empty and a last page.

    A page's documents lie within RUN numbers, so documents are dealt by these runs,
    once and not under each of their topics.
    """
    run = F.greatest(F.expr(f"doc_id div {RUN}"), F.lit(0)).alias("run")
    docs = table(spark, sf_dir, "documents").select("*", run).repartition("run")
    grouped = _listed(docs, "run").groupBy("run", "topic", "page").agg(
        F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("hits")
    )
    at = lambda topic, page: (F.col("topic") == topic) & (F.col("page") == page)
    body = F.array_join(F.transform("hits", lambda h: h["json"]), ",")
    last = F.when(F.col("topic") == "s5", ',"nbPages":2}').when(
        F.col("topic").startswith("tag"), ',"nbPages":1000000000}'
    ).otherwise("}")
    payload = F.concat(F.lit('{"hits":['), F.when(at("s6", 1), "").otherwise(body), F.lit("]"), last)
    return grouped.filter(~at("s4", 2)).select(
        "topic", "page",
        F.when(at("s3", 2), F.substring(payload, 1, 20)).otherwise(payload).alias("payload"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_page_facts(pages(spark, sf_dir))


def topics(spark: SparkSession) -> DataFrame:
    use_utc(spark)
    return topic_frame(spark, TOPICS)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-label rows: quality as sentiment, toxic as category; some labels and predictions blank."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    g = table(spark, sf_dir, "labels").join(d, "doc_id")
    doc = F.col("doc_id")
    return g.select(
        doc.cast("string").alias("id"), F.col("source").alias("topic"), "text",
        F.when(doc % 17 == 0, " ").when(doc % 19 == 0, F.lit(None)).when(F.col("n_chars") >= 1000, "good").otherwise(
            " POOR ").alias("predicted_sentiment"),
        F.when(doc % 13 == 0, F.lit(None)).when(F.col("n_chars") % 2 == 1, "Toxic").otherwise("clean").alias(
            "predicted_category"),
        F.when(doc % 9 == 0, "  ").when(F.col("quality") == 1, " Good").otherwise("poor ").alias("true_sentiment"),
        F.when(doc % 11 == 0, F.lit(None)).when(F.col("toxic") == 1, "toxic").otherwise("CLEAN").alias("true_category"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as run starts, purchases as run finishes."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "purchase"))
    n = F.floor("value").cast("bigint")
    zero = F.lit(0).cast("bigint")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "signup", "start").otherwise("finish").alias("event"),
        F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"),
        zero.alias("fetched"), n.alias("from_cache"), (n * 20).alias("normalised"),
        (n % 7).alias("quarantined"), (n * 2).alias("inserted"), (n * 18).alias("duplicates"),
        (n * 2).alias("classified"),
    )


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct lower-case words of three letters or more of all documents, with a digest."""
    words = texts(spark, sf_dir).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.where(F.length("word") >= 3).distinct().withColumn("h", F.sha2("word", 256))


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("int")


def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per word of the documents, of four forms and in random order."""
    word, h = F.col("word"), F.col("h")
    form = F.expr("conv(substr(h, 16, 1), 16, 10) div 4")
    pattern = (
        F.when(form == 0, F.concat(F.lit(r"\b"), word, F.lit(r"\b")))
        .when(form == 1, F.concat(F.lit(r"\b"), word, F.lit(r"(?:s|ed)?\b")))
        .when(form == 2, F.concat(F.lit(r"\b"), F.substring(word, 1, 5), F.lit(r"\w*")))
        .otherwise(F.concat(F.lit(r"\b"), word, F.lit(r" \w+")))
    )
    return _letters(spark, sf_dir).select(
        _number(F.substring(h, 1, 7)).alias("rule_order"), _number(F.substring(h, 8, 7)).alias("pattern_order"),
        F.concat(F.lit("c"), (_number(F.substring(h, 17, 4)) % 97).cast("string")).alias("category"),
        pattern.alias("pattern"),
    )


def lexicon_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every fourth word of the documents, in four endings; some words get several."""
    h = F.col("h")
    scored = _letters(spark, sf_dir).where(F.substring(h, 1, 1) < "4")
    scored = scored.withColumn("ending", F.explode(F.array(*map(F.lit, ("", "s", "ed", "ing")))))
    return scored.select(
        F.concat("word", "ending").alias("word"), ((_number(F.substring(h, 2, 4)) % 61 - 30) / 10.0).alias("score")
    )
