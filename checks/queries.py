"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from hearsay.functions.category import category_rules, rules_from_table
from hearsay.functions.hits import coerce_int as as_int
from hearsay.functions.hits import field
from hearsay.functions.labels import classify as classify_text
from hearsay.functions.sentiment import lexicon_score, sentiment_bucket
from hearsay.functions.text import clean_text, html_unescape, truncate
from hearsay.functions.times import iso_text, to_utc
from hearsay.operators import evaluate as ev
from hearsay.operators import labelling, normalise, pages, report, report_state, runs, upsert
from hearsay.operators.lexicon_table import score_by_lexicon_table
from hearsay.operators.rule_table import label_by_rule_table
from hearsay.plans import ingest
from hearsay.session import local_frame, shared_folder, spread
from hearsay.sources import landing
from hearsay.sources.gold import GOLD_COLUMNS
from hearsay.sources.store import MentionStore, table_counts
from hearsay.streaming.ingest import ingest_stream

N_TOPICS = len(v.TOPICS)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _iso(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: iso_text(F.col(n)) for n in names})


def _r6(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.round(n, 6) for n in names})


# Landing and paging


@query
def raw_page_scan(spark, sf):
    return v.landed(spark, sf).select(
        "topic", "page", "n_hits", "nb_pages"
    )


@query
def landing_path(spark, sf):
    d = v.table(spark, sf, "documents")
    topic = F.concat_ws("/", "source", "lang", F.lit("é ½."))
    path = landing.page_path(topic, F.col("doc_id"))
    full = F.concat(F.lit("raw/"), path)
    return d.select(
        "doc_id", path.alias("path"),
        landing.topic_of_path(full).alias("folder"), landing.page_of_path(full).alias("page"),
    )


@query
def corrupt_pages(spark, sf):
    return landing.corrupt_pages(v.landed(spark, sf))


@query
def land_new_pages(spark, sf):
    """Every page arrives again; those of the `tag` topics are landed already."""
    incoming = v.landed(spark, sf)
    landed = incoming.filter(F.col("topic").startswith("tag"))
    return landing.new_pages(incoming, landed).select("topic", "page", "n_hits")


@query
def explode_hits(spark, sf):
    hits = pages.explode_hits(v.landed(spark, sf).filter("n_hits is not null"))
    return hits.select("topic", "page", "pos", field(F.col("hit"), "objectID").alias("object_id"))


@query
def accepted_pages(spark, sf):
    kept = pages.accepted_pages(v.landed(spark, sf), v.topics(spark), N_TOPICS)
    return kept.select("topic", "page", "n_hits")


@query
def cap_per_topic(spark, sf):
    hits = pages.capped_hits(v.landed(spark, sf), v.topics(spark), N_TOPICS, v.PAGE_SIZE, v.CAP)
    return hits.select("topic", "page", "pos", field(F.col("hit"), "objectID").alias("object_id"))


@query
def hits_per_topic(spark, sf):
    hits = ingest.batch_hits(spark, v.landed(spark, sf), v.settings())
    return pages.hits_per_topic(hits, v.topics(spark))


@query
def page_counters(spark, sf):
    facts = v.landed(spark, sf).select("topic", "page", "n_hits", "nb_pages")
    return pages.page_counters(pages.frontier(facts, v.topics(spark), N_TOPICS))


# Normalisation


def _assessed(spark, sf) -> DataFrame:
    fetched = F.lit(v.FETCHED_AT).cast("timestamp")
    return normalise.assess_hits(v.hits(spark, sf), fetched, "documents")


@query
def normalise_hits(spark, sf):
    return _iso(normalise.valid_records(_assessed(spark, sf)), "created_at", "fetched_at").drop(
        *normalise.ORDER_COLUMNS, "sentiment", "sentiment_score", "category"
    )


@query
def quarantine_rows(spark, sf):
    rows = normalise.rejected_hits(_assessed(spark, sf))
    return rows.select("topic", "page", "pos", "raw_id", "reason", "payload", "payload_hash")


@query
def text_fallback(spark, sf):
    """Title, story and comment present in turn, empty in turn."""
    d = v.table(spark, sf, "documents")
    doc = F.col("doc_id")
    text = normalise.choose_text(
        F.when(doc % 3 == 0, F.concat(F.lit(" <b>"), "lang", F.lit("</b> "))).when(doc % 3 == 1, "<br>"),
        F.when(doc % 5 == 0, "<p></p>").when(doc % 5 == 1, "").when(doc % 5 == 2, F.col("text")),
        F.when(doc % 7 != 0, F.concat(F.lit("<i>"), "source", F.lit("</i>"))),
    )
    return d.select("doc_id", text.alias("chosen"))


@query
def url_default(spark, sf):
    p = v.table(spark, sf, "pages")
    url = F.when(F.col("page_id") % 3 == 0, F.lit(None)).when(F.col("page_id") % 3 == 1, "").otherwise(F.col("url"))
    key = F.col("page_id").cast("string")
    return p.select("page_id", normalise.default_url(url, key).alias("url"))


@query
def required_fields(spark, sf):
    d = v.table(spark, sf, "documents")
    doc = F.col("doc_id")
    key = doc.cast("string")
    values = {
        "id": F.when(doc % 11 == 0, " ").otherwise(key),
        "topic": F.when(doc % 7 == 0, "\t").otherwise(F.col("source")),
        "text": F.when(doc % 5 == 0, "").otherwise(F.col("text")),
        "created_at": F.when(doc % 3 == 0, F.lit(None)).otherwise(F.timestamp_seconds(doc)),
    }
    return d.select("doc_id", normalise.missing_field(values["id"], values).alias("reason"))


@query
def payload_hash(spark, sf):
    d = v.table(spark, sf, "documents")
    key = normalise.payload_hash(F.col("source"), F.col("text"))
    return d.select("doc_id", key.alias("payload_hash"))


@query
def truncate_text(spark, sf):
    d = v.table(spark, sf, "documents")
    return d.select("doc_id", truncate(F.col("text"), 90).alias("excerpt"))


# Scalar functions


@query
def clean_text_pages(spark, sf):
    p = spread(v.table(spark, sf, "pages"), "page_id")
    return p.select("page_id", clean_text(F.col("html")).alias("text"))


QUERIES["clean_text"] = QUERIES.pop("clean_text_pages")


@query
def html_unescape_pages(spark, sf):
    p = spread(v.table(spark, sf, "pages"), "page_id")
    return p.select("page_id", html_unescape(F.col("html")).alias("html"))


QUERIES["html_unescape"] = QUERIES.pop("html_unescape_pages")


def _time_json() -> Column:
    """Event time as epoch, ISO text of several forms, or unusable."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_id") % 9
    number = lambda part, size: F.lpad(F.extract(F.lit(part), ts).cast("string"), size, "0")
    week = F.concat(
        number("YEAROFWEEK", 4), F.lit("-W"), number("WEEK", 2), F.lit("-"), number("DAYOFWEEK_ISO", 1),
        F.date_format(ts, "'T'HH:mm:ss"),
    )
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(kind == 1, F.concat(text, F.lit("Z")))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.concat(text, F.lit("+02:30")))
        .when(kind == 4, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(kind == 5, "22:13")
        .when(kind == 6, week)
        .when(kind == 7, F.concat(text, F.lit("-01:00:30.25")))
        .when(kind == 8, F.date_format(ts, "yyyy-MM-dd HH:mm:ss '+0100'"))
    )
    epoch = F.when(kind == 0, F.unix_seconds(ts).cast("string")).when(kind == 1, "abc").when(
        kind == 2, "99999999999999"
    )
    return F.to_json(F.struct(epoch.alias("created_at_i"), written.alias("created_at")))


@query
def to_utc_time(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", F.parse_json(_time_json()).alias("hit"))
    ts = to_utc(as_int(F.col("hit"), "created_at_i"), field(F.col("hit"), "created_at"))
    return e.select("event_id", iso_text(ts).alias("created_at"))


@query
def iso_format(spark, sf):
    e = v.table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    whole = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", ts)).otherwise(ts)
    return e.select("event_id", iso_text(whole).alias("iso"))


@query
def coerce_int(spark, sf):
    """Event values as JSON number, padded text, decimal text, list and boolean."""
    kind, value = F.col("event_id") % 5, F.col("value").cast("string")
    whole = F.floor("value").cast("string")
    raw = (
        F.when(kind == 0, value)
        .when(kind == 1, F.concat(F.lit('" '), whole, F.lit(' "')))
        .when(kind == 2, F.concat(F.lit('"x'), value, F.lit('"')))
        .when(kind == 3, F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise("true")
    )
    e = v.table(spark, sf, "events").select(
        "event_id", F.parse_json(F.concat(F.lit('{"n":'), raw, F.lit("}"))).alias("hit")
    )
    return e.select("event_id", as_int(F.col("hit"), "n").alias("n"))


@query
def json_fields(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", F.parse_json("props").alias("props"))
    return e.select(
        "event_id", field(F.col("props"), "k", "bigint").alias("k"), field(F.col("props"), "none").alias("missing")
    )


# Store


@query
def dedupe_batch(spark, sf):
    kept = upsert.last_per_id(normalise.valid_records(_assessed(spark, sf)))
    return kept.select("id", "topic", F.length("text").alias("text_chars"))


def _batch(spark, sf) -> DataFrame:
    return upsert.last_per_id(normalise.valid_records(_assessed(spark, sf)))


def _stored(spark, sf) -> DataFrame:
    """What an earlier run stored: the English mentions."""
    return v.mentions(spark, sf).filter("author = 'en'")


@query
def upsert_new_mentions(spark, sf):
    return upsert.insert_or_ignore(_batch(spark, sf), _stored(spark, sf), "id").select(
        "id", "topic", F.length("text").alias("text_chars")
    )


@query
def upsert_counts(spark, sf):
    return upsert.upsert_counts(_batch(spark, sf), _stored(spark, sf))


@query
def quarantine_upsert(spark, sf):
    """Every reject arrives twice; those of the `tag` topics are in the quarantine already."""
    rejects = _kept(spark, normalise.rejected_hits(_assessed(spark, sf)), "rejects")
    stored = rejects.filter(F.col("topic").startswith("tag"))
    kept = upsert.insert_or_ignore(
        upsert.first_per_payload(rejects.union(rejects)), stored, "payload_hash"
    )
    return kept.select("payload_hash", "raw_id", "topic", "reason", "payload")


@query
def quarantine_copies(spark, sf):
    """Rejects carry the document's text as payload, so copies share a hash."""
    rejects = normalise.rejected_hits(_assessed(spark, sf))
    texts = v.listed(spark, sf).join(
        v.table(spark, sf, "documents").select("doc_id", "text"), "doc_id"
    ).select("topic", "page", "pos", F.col("text").alias("payload"))
    rejects = rejects.drop("payload", "payload_hash").join(texts, ["topic", "page", "pos"])
    rejects = rejects.withColumn(
        "payload_hash", normalise.payload_hash(F.lit("any"), F.col("payload"))
    )
    stored = v.table(spark, sf, "documents").filter("lang = 'de'").select(
        normalise.payload_hash(F.lit("any"), F.col("text")).alias("payload_hash")
    )
    kept = upsert.insert_or_ignore(upsert.first_per_payload(rejects), stored, "payload_hash")
    return kept.select("payload_hash", "raw_id", "topic", "reason", "payload")


def _hand_labels(spark, sf) -> DataFrame:
    good = F.col("quality") == 1
    return v.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(good, "positive").otherwise("negative").alias("sentiment"),
        F.when(good, 0.5).otherwise(-0.5).alias("sentiment_score"),
        F.when(F.col("toxic") == 1, "criticism").otherwise("other").alias("category"),
    )


@query
def apply_labels(spark, sf):
    labelled = upsert.apply_labels(v.mentions(spark, sf), _hand_labels(spark, sf))
    return labelled.select("id", "topic", "sentiment", "sentiment_score", "category")


@query
def unlabelled(spark, sf):
    return upsert.unlabelled(v.mentions(spark, sf)).select("id", "title", F.length("text").alias("text_chars"))


@query
def all_mentions(spark, sf):
    return _iso(report.all_mentions(v.mentions(spark, sf)), "created_at", "fetched_at")


def _run_log(spark, sf) -> DataFrame:
    return runs.run_log(v.run_events(spark, sf))


@query
def table_counts_query(spark, sf):
    rejects = normalise.rejected_hits(_assessed(spark, sf))
    return table_counts({
        "mentions": v.mentions(spark, sf), "quarantine": rejects, "run_log": _run_log(spark, sf),
    })


QUERIES["table_counts"] = QUERIES.pop("table_counts_query")


@query
def run_log_latest(spark, sf):
    return _iso(_run_log(spark, sf), "started_at", "finished_at")


@query
def run_history(spark, sf):
    return runs.run_history(_run_log(spark, sf))


@query
def batch_counters(spark, sf):
    return ingest.batch_counters(
        spark, v.landed(spark, sf), _stored(spark, sf), v.settings(), v.FETCHED_AT
    )


# Classification


@query
def lexicon_sentiment(spark, sf):
    d = v.texts(spark, sf)
    return d.select("doc_id", lexicon_score(F.col("text"), v.LEXICON, v.WORDS).alias("score"))


@query
def sentiment_bucket_query(spark, sf):
    d = v.table(spark, sf, "documents")
    score = (F.col("n_chars") % 41 - 20) / 200.0
    text = F.when(F.col("doc_id") % 17 == 0, " \n").otherwise(F.col("text"))
    return d.select("doc_id", sentiment_bucket(text, score).alias("sentiment"))


QUERIES["sentiment_bucket"] = QUERIES.pop("sentiment_bucket_query")


def _labelled_by(frame: DataFrame, rules) -> DataFrame:
    found = frame.select("doc_id", category_rules(F.col("text"), rules).alias("c"))
    return found.select("doc_id", "c.category", "c.matched_term")


@query
def category_rules_query(spark, sf):
    return _labelled_by(v.texts(spark, sf), v.RULES)


QUERIES["category_rules"] = QUERIES.pop("category_rules_query")


@query
def category_rules_default(spark, sf):
    return _labelled_by(v.texts(spark, sf), None)


@query
def category_rules_subset(spark, sf):
    """Rules come as a table and are kept to the configured categories."""
    flat = [
        (i, name, j, p) for i, (name, ps) in enumerate(v.RULES) for j, p in enumerate(ps)
    ]
    rules = local_frame(
        spark,
        dict(zip(("rule_order", "category", "pattern_order", "pattern"), map(list, zip(*flat)))),
        "rule_order int, category string, pattern_order int, pattern string",
    )
    enabled = local_frame(spark, {"category": ["french", "english"]}, "category string")
    return _labelled_by(v.texts(spark, sf), rules_from_table(rules, enabled))


def _kept(spark, frame: DataFrame, name: str) -> DataFrame:
    """A derived table, written as the tables of a real run are."""
    folder = shared_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.parquet(folder)


@query
def category_rules_table(spark, sf):
    """One rule per word of the documents: tens of thousands, met through an index."""
    rules = _kept(spark, v.rule_table(spark, sf), "rules")
    found = label_by_rule_table(v.texts(spark, sf).select("doc_id", "text"), rules, key=("doc_id",))
    return found.select("doc_id", "category", "matched_term")


@query
def lexicon_table_sentiment(spark, sf):
    lexicon = _kept(spark, v.lexicon_table(spark, sf), "lexicon")
    d = v.texts(spark, sf).select("doc_id", "text")
    return score_by_lexicon_table(d, lexicon, v.WORDS, key=("doc_id",)).select("doc_id", "score")


@query
def classify(spark, sf):
    d = v.texts(spark, sf).select(
        "doc_id", classify_text(F.col("text"), v.settings()).alias("l")
    )
    return d.select("doc_id", "l.*")


@query
def label_pending(spark, sf):
    return labelling.label_pending(spread(v.mentions(spark, sf), "id"), v.settings())


# Reports


@query
def sentiment_by_topic(spark, sf):
    return report.sentiment_by_topic(v.mentions(spark, sf))


@query
def sentiment_share(spark, sf):
    return report.sentiment_share(report.sentiment_by_topic(v.mentions(spark, sf)))


@query
def category_distribution(spark, sf):
    return report.category_distribution(v.mentions(spark, sf))


@query
def headline_counts(spark, sf):
    return report.headline_counts(
        v.mentions(spark, sf), normalise.rejected_hits(_assessed(spark, sf))
    )


@query
def top_items_per_topic(spark, sf):
    return report.top_items_per_topic(v.mentions(spark, sf))


@query
def distinct_topics(spark, sf):
    return report.distinct_topics(v.mentions(spark, sf))


@query
def incremental_report(spark, sf):
    """Three batches of mentions, the last of which also gives labels to earlier ones; reports from their states."""
    counts, items = (shared_folder(spark, f"report-{name}") for name in ("counts", "items"))
    m, labels = v.mentions(spark, sf), _hand_labels(spark, sf)
    for batch in range(3):
        part = m.where(F.col("id").cast("long") % 3 == batch)
        came, went = part, None
        if batch == 2:
            # The batch itself is labelled before it is counted; of earlier ones the change counts.
            came = upsert.apply_labels(part, labels)
            new, went = report_state.relabelled(m.where(F.col("id").cast("long") % 3 < 2), labels)
            cell = [*report_state.CELL, "sentiment_score"]
            came = came.select(*cell).unionByName(new.select(*cell))
        report_state.count_changes(came, went).write.parquet(f"{counts}/batch={batch}")
        report_state.best_items(part).write.parquet(f"{items}/batch={batch}")
    state = report_state.merge_counts(spark.read.parquet(counts))
    current = upsert.apply_labels(m.select("id", "sentiment", "sentiment_score", "category"), labels)
    best = report_state.top_items(spark.read.parquet(items), current, 3)
    none = lambda kind: F.lit(None).cast(kind)
    line = lambda section, topic, name, n, value: [
        F.lit(section).alias("section"), topic.alias("topic"), name.alias("name"), n.cast("bigint").alias("n"),
        value.cast("double").alias("value"),
    ]
    by_topic = report_state.sentiment_by_topic(state)
    sides = [
        by_topic.select(*line("topic", F.col("topic"), F.lit(c), F.col(c), F.col("mean_score")))
        for c in ("total", "positive", "neutral", "negative")
    ]
    head = report_state.headline_counts(state, 0)
    sides += [head.select(*line("headline", none("string"), F.lit(c), F.col(c), none("double"))) for c in ("total", "topics", "unlabelled")]
    sides.append(report_state.category_distribution(state).select(
        *line("category", none("string"), F.col("category"), F.col("n"), F.col("share_pct"))))
    sides.append(report_state.distinct_topics(state).select(*line("topics", F.col("topic"), none("string"), none("bigint"), none("double"))))
    shown = F.concat_ws("|", "id", "label", "sentiment", "category", "points", "url")
    sides.append(best.select(*line("best", F.col("topic"), shown, F.col("rank"), none("double"))))
    whole = sides[0]
    for side in sides[1:]:
        whole = whole.unionByName(side)
    return whole


# Evaluation


@query
def seeded_sample(spark, sf):
    return ev.seeded_sample(v.mentions(spark, sf)).select("id", "topic", "sentiment")


@query
def gold_template(spark, sf):
    return ev.gold_template(v.mentions(spark, sf)).select(*GOLD_COLUMNS)


def _confusion(spark, sf) -> DataFrame:
    return ev.confusion_counts(ev.label_pairs(v.gold(spark, sf)))


@query
def label_pairs(spark, sf):
    """Pairs have no key, so equal ones are counted."""
    pairs = ev.label_pairs(v.gold(spark, sf))
    return pairs.groupBy("kind", "true", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query
def label_universe(spark, sf):
    return ev.label_universe(ev.label_pairs(v.gold(spark, sf)))


@query
def eval_accuracy(spark, sf):
    return _r6(ev.accuracy(_confusion(spark, sf)), "accuracy")


@query
def confusion_counts(spark, sf):
    return _confusion(spark, sf)


@query
def confusion_grid(spark, sf):
    return ev.confusion_grid(_confusion(spark, sf))


@query
def class_metrics(spark, sf):
    return _r6(ev.class_metrics(_confusion(spark, sf)), "precision", "recall", "f1")


@query
def evaluation_report(spark, sf):
    return _r6(ev.evaluation_report(ev.label_pairs(v.gold(spark, sf))), "value")


@query
def disagreements(spark, sf):
    return ev.disagreements(v.gold(spark, sf))


def _store(spark, name: str) -> MentionStore:
    work = shared_folder(spark, name)
    return MentionStore(spark, "hearsay_" + work.rsplit("-", 1)[-1], f"{work}/store", buckets=8)


@query
def store_after_compaction(spark, sf):
    """Mentions and labels appended in five batches, then both tables rewritten to one file per bucket."""
    store, m = _store(spark, "compaction"), v.mentions(spark, sf)
    for batch in range(5):
        part = m.where(F.col("id").cast("long") % 5 == batch)
        store.append(part, "mentions_base")
        label = part.where("sentiment is not null or category is not null")
        store.append(label.select(
            "*", F.lit(None).cast("string").alias("matched_term"), F.lit(v.FETCHED_AT).cast("timestamp").alias("labelled_at")
        ), "mention_labels")
    for table in ("mentions_base", "mention_labels"):
        store.compact(table, delete_old=True)
    return _iso(store.mentions(), "created_at", "fetched_at")


@query
def store_report(spark, sf):
    """The landed pages run twice into a store; the second run finds nothing new. Reports from the store's states."""
    work = shared_folder(spark, "store-report")
    landing.land(spark, v.pages(spark, sf), f"{work}/landing")
    store = _store(spark, "store-report")
    for run in range(2):
        ingest.run(spark, f"{work}/landing", store, v.settings(), f"run-{run}", v.FETCHED_AT, v.FETCHED_AT)
    parts = store.report()
    by_topic = parts["sentiment_by_topic"]
    line = lambda frame, section, topic, name, n: frame.select(
        F.lit(section).alias("section"), topic.alias("topic"), name.alias("name"), n.cast("bigint").alias("n"))
    none = F.lit(None).cast("string")
    sides = [line(by_topic, "topic", F.col("topic"), F.lit(c), F.col(c)) for c in ("total", "positive", "neutral", "negative")]
    sides.append(line(parts["category_distribution"], "category", none, F.col("category"), F.col("n")))
    sides += [line(parts["headline"], "headline", none, F.lit(c), F.col(c)) for c in ("total", "topics", "quarantined", "unlabelled")]
    shown = F.concat_ws("|", "id", "category", "points")
    sides.append(line(parts["top_items"], "best", F.col("topic"), shown, F.col("rank")))
    whole = sides[0]
    for side in sides[1:]:
        whole = whole.unionByName(side)
    return whole


# Streaming


@query
def incremental_ingest(spark, sf):
    """Land all pages, ingest them as a stream, land them again, ingest again."""
    work = shared_folder(spark, "incremental-ingest")
    settings = v.settings()
    store = MentionStore(spark, "hearsay_" + work.rsplit("-", 1)[-1], f"{work}/store", buckets=8)
    for _ in range(2):
        landing.land(spark, v.pages(spark, sf), f"{work}/landing")
        stream = ingest_stream(
            spark, f"{work}/landing", store, settings, f"{work}/checkpoint", lambda: v.FETCHED_AT
        )
        stream.awaitTermination()
    return _iso(store.mentions(), "created_at", "fetched_at")
