"""Lexicon sentiment with a lexicon of any size, held as a table.

Every word of a text, with its place, meets the lexicon in a join; the few that it
holds are brought back to their text in order, and weighed there by their
neighbours as in `functions.sentiment`. Only the lexicon is joined this way: the
rule words and idioms are part of the settings and small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.functions.sentiment import hits_score, scored_words
from hearsay.session import BROADCAST_ROWS
from hearsay.settings import SentimentRules

# Texts that are looked at to find the frequent words; every other text's words are looked up all the same.
SAMPLE_TEXTS = 20_000
HITS = "array<struct<i:int,v:double>>"


def score_by_lexicon_table(
    texts: DataFrame, lexicon: DataFrame, rules: SentimentRules | None = None, text_col: str = "text",
    key: tuple[str, ...] = (),
) -> DataFrame:
    """`texts` with `score`, by `lexicon(word, score)`; of several scores for a word the greatest counts.

    `key` names columns that tell rows apart, so that copies of a text do not share
    one join key. A lexicon of a counted small size is broadcast and no word moves.
    Of a larger one the texts' most frequent words are broadcast, held or not, so that
    only rare words move to the lexicon and none of them is a hot key.
    """
    text = F.col(text_col)
    words = lexicon.where("word is not null and score is not null").groupBy("word").agg(
        F.max("score").cast("double").alias("v")
    )
    keys = [F.xxhash64(F.lit(i), text, *key).alias(f"_k{i}") for i in (1, 2)]
    rows = texts.select("*", *keys)
    low = F.transform(scored_words(text), F.lower)
    placed = rows.select("_k1", "_k2", F.posexplode(low).alias("i", "word"))
    if words.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        met = placed.join(F.broadcast(words), "word")
    else:
        common = frequent_words(rows.select("_k1", low.alias("_low")))
        known = F.broadcast(common.join(words, "word", "left"))
        columns = ["_k1", "_k2", "i", "v"]
        met = placed.join(known.where("v is not null"), "word").select(*columns).unionByName(
            placed.join(F.broadcast(common), "word", "left_anti").join(words, "word").select(*columns)
        )
    # As a set: rows equal in text and key share their hits.
    hits = met.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set(F.struct("i", "v"))).alias("_hits"))
    found = F.coalesce("_hits", F.array().cast(HITS))
    joined = rows.join(hits, ["_k1", "_k2"], "left")
    return joined.select(*texts.columns, hits_score(text, lambda _: found, rules).alias("score"))


def frequent_words(rows: DataFrame) -> DataFrame:
    """At most `BROADCAST_ROWS` words `(word)`, the most frequent ones of some `rows(_k1, _low)`.

    Any choice gives the same scores: words that it leaves out go the longer way.
    """
    parts = max(rows.count() // SAMPLE_TEXTS, 1)
    some = rows.where(F.pmod("_k1", F.lit(parts)) == 0).select(F.explode("_low").alias("word"))
    counts = some.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.orderBy(F.col("n").desc(), "word").limit(BROADCAST_ROWS).select("word")
