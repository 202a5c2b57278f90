"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.llm.bpe import bpe_round_trip
from hearsay.llm.exact_dedup import exact_dedup
from hearsay.llm.hmm_scoring import hmm_scoring
from hearsay.llm.html_extraction import main_text
from hearsay.llm.importance import resample
from hearsay.llm.mixing import mix_sources
from hearsay.llm.ngram_join import ngram_join
from hearsay.llm.prefix_trie import prefix_trie, rebuilt
from hearsay.llm.quality_rules import quality_rules
from hearsay.llm.secret_scan import KINDS, secret_scan
from hearsay.llm.site_quality import site_quality
from hearsay.llm.toxicity import score_chain, train_chain
from hearsay.llm.url_filter import Rule, url_filter

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# The rules of the URL contract.
URL_RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label) of the pages whose path ends in the id of a labelled document.

    The id begins the last segment; an extension or a slash may follow it. Query and
    fragment do not count, nor does the host.
    """
    path = F.regexp_extract("url", r"(?s)^(?:.*?://[^/?#]*)?([^?#]*)", 1)
    number = F.regexp_extract(path, r"/([0-9]{1,18})[^0-9/]*/?$", 1)
    named = pages.select("url", number.alias("n")).where("n <> ''").selectExpr("url", "cast(n as bigint) as doc_id")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return named.join(labels.select("doc_id", bad.cast("int").alias("label")), "doc_id").select("url", "label")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter(pages, labelled_urls(pages, _table(spark, sf_dir, "labels")), URL_RULES)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("__key")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"), size=3, num=90, den=100)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scoring(_table(spark, sf_dir, "documents"))


def _joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != KINDS[-1])), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site of a document is its source, the path its language section."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    return site_quality(_table(spark, sf_dir, "documents"), labels, host_col="source", path_col="lang")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(_table(spark, sf_dir, "documents"), VOCABULARY)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain: junk (low quality), toxic, and both at once."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("junk"), "toxic", ((1 - F.col("quality")) * F.col("toxic")).alias("toxic_junk")
    )
    chain = train_chain(docs, labels, ["junk", "toxic", "toxic_junk"])
    return score_chain(docs, chain).withColumn("toxic", F.col("p_toxic") >= chain.cuts[1])


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark texts."""
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10, min_words=20)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(_table(spark, sf_dir, "conversations"), block=100, heads=6))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_mixing, op3_ngram_join, op4_quality_rules, op5_hmm_scoring, op6_secret_scan, op7_site_quality,
    op8_bpe, op9_exact_dedup, op10_toxicity, op11_importance, op12_prefix_trie, op13_html_extraction,
)}
