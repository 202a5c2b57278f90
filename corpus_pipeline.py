"""A corpus for training, from raw documents: filter, dedupe, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes
every stage's result as Parquet in the shared scratch folder and reads it back as
the next stage's input, so a stage starts from files and a lost executor costs
its own tasks. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hearsay.llm.bpe import bpe_round_trip
from hearsay.llm.common import delete_folder, leave_to_exit, scratch
from hearsay.llm.exact_dedup import drop_exact_copies
from hearsay.llm.mixing import mixed_documents
from hearsay.llm.ngram_join import one_per_component
from hearsay.llm.quality_rules import keep_good
from hearsay.session import shared_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or their source's fences go."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest id stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, five words, 0.8: of each group the smallest id stays."""
    return one_per_component(docs, size=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: small sources are repeated up to twice, every document is read at least once."""
    return mixed_documents(docs, max_repetition=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: packed ids and their decoded text, in mixed order."""
    return bpe_round_trip(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

# SQL can express neither the bisected mix nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's scratch tables go when it is written, its result when the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = shared_folder(spark, "pipeline-" + name.split(" ")[0].lower())
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(folder), folder
    leave_to_exit(before)
    return docs
