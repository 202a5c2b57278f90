"""Sentiment, categories, labels, lexicon loading."""

import pytest
from pyspark.sql import functions as F

from hearsay.functions.category import category_rules, enabled_rules
from hearsay.functions.labels import classify
from hearsay.functions.sentiment import lexicon_score
from hearsay.settings import CATEGORY_RULES, RunSettings, SentimentRules, Topic
from hearsay.sources.lexicon import lexicon_pairs, read_lexicon

SETTINGS = RunSettings(topics=(Topic("t"),))


def label(spark, *texts, settings=SETTINGS):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = frame.select("i", classify(F.col("t"), settings).alias("l")).orderBy("i").collect()
    return [r["l"] for r in rows]


def test_buckets(spark):
    got = label(spark, "What a wonderful anvil, I love it", "A terrible thing, and broken", "Version 4 came on Tuesday")
    assert [x.sentiment for x in got] == ["positive", "negative", "neutral"]


def test_blank_text(spark):
    for x in label(spark, "", None, " \n"):
        assert (x.sentiment, x.score, x.category, x.matched_term) == ("neutral", 0.0, "other", None)


# Scores worked out by hand from the published rules, with valence good 1.9.
SCORES = [
    ("good", 1.9),
    ("it is not good", 1.9 * -0.74),
    ("it isn't good", 1.9 * -0.74),
    ("it is very good", 1.9 + 0.293),
    ("very much good", 1.9 + 0.293 * 0.95),
    ("very much more good", 1.9 + 0.293 + 0.293 * 0.9),
    ("slightly good", 1.9 - 0.293),
    ("it is GOOD", 1.9 + 0.733),
    ("GOOD", 1.9),
    ("VERY good indeed", 1.9 + 0.293 + 0.733),
    ("good!!", 1.9 + 2 * 0.292),
    ("good!!!!!!", 1.9 + 4 * 0.292),
    ("good??", 1.9 + 0.36),
    ("good????", 1.9 + 0.96),
    ("bad!", -2.5 - 0.292),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("never so good", (1.9 + 0.293) * 1.25),
    ("without doubt good", 1.9),
    ("no good", 1.9 * -0.74),
    ("no", -1.2),
    ("least good", 1.9 * -0.74),
    ("at least good", 1.9),
    ("very", 0.0),
    ("good.", 1.9),
    ("just sort of good", 1.9 + -0.293),
]


def test_score_rules(spark):
    texts = [t for t, _ in SCORES]
    want = [round(raw / (raw * raw + 15) ** 0.5, 4) for _, raw in SCORES]
    got = dict(zip(texts, (x.score for x in label(spark, *texts))))
    assert got == {t: pytest.approx(w, abs=1e-4) for t, w in zip(texts, want)}


CATEGORIES = [
    ("Releasing a faster api today", "product_launch", "Releasing"),
    ("plonk drizzle qwv", "other", None),
    ("a husband with a banjo", "other", None),
    ("announcements", "other", None),
    ("we build it", "other", None),
    ("we built it", "technical_discussion", "built"),
    ("worth $1.5 billion", "product_launch", "1.5"),
    ("a DEAL with GitHub", "business_news", "DEAL"),
    ("GitHub issues", "criticism", "issues"),
    ("Open-Source models", "technical_discussion", "Open-Source"),
    ("écode", "other", None),
]


def test_categories(spark):
    got = label(spark, *[c[0] for c in CATEGORIES])
    assert [(x.category, x.matched_term) for x in got] == [c[1:] for c in CATEGORIES]


def test_only_enabled_categories(spark):
    kept = enabled_rules(CATEGORY_RULES, ["criticism", "other"])
    frame = spark.createDataFrame([("Announcing an API with bugs",), ("Announcing",)], "t string")
    rows = frame.select(category_rules(F.col("t"), kept).alias("c")).collect()
    assert [tuple(r["c"]) for r in rows] == [("criticism", "bugs"), ("other", None)]


def test_labels_are_deterministic(spark):
    text = "Anvil pricing is a great concern"
    assert len(set(map(tuple, label(spark, text, text)))) == 1


def test_lexicon_file(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text("Good\t1.9\t0.9\nodd line\nbad\t-2.5\t1\n")
    assert lexicon_pairs(read_lexicon(spark, str(tmp_path / "lexicon.txt"))) == {"good": 1.9, "bad": -2.5}


def test_settings_checks():
    assert "other" in RunSettings(topics=(Topic("a"),), categories=("criticism",)).categories
    assert RunSettings(topics=(Topic("a"),)).max_pages is None
    assert RunSettings(topics=(Topic("a"),), max_items_per_topic=100).max_pages == 2
    for topics in ((), (Topic("a"), Topic("a")), (Topic(""),)):
        with pytest.raises(ValueError):
            RunSettings(topics=topics)


def test_phrases_are_made_only_behind_a_first_word(spark):
    rules = SentimentRules(idioms=(("bad to the", 2.0), ("to the", 1.0), ("good", -1.0), ("kind of", 0.5)))
    texts = ["it was bad to the bone", "to the good", "x y z good", "so kind of good", "bad to", "to the", "a b c, bad to the."]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    score = lexicon_score(F.col("t"), {"bad": -2.5, "good": 1.9, "bone": 0.5, "the": 0.1}, rules)
    plan = frame.select(score)._jdf.queryExecution().optimizedPlan().toString()
    assert " IN (bad,good,kind,to)" in plan
    assert [r[0] is not None for r in frame.select(score).collect()] == [True] * len(texts)
