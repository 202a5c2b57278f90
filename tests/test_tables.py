"""Rule tables, lexicon tables and report states against their plain counterparts."""

import random

import pytest
from pyspark.sql import functions as F

import hearsay.operators.lexicon_table as lexicon_table
import hearsay.operators.rule_table as rule_table
from hearsay.functions.category import category_rules
from hearsay.functions.sentiment import STARTER_LEXICON, lexicon_score
from hearsay.operators import report, report_state
from hearsay.operators.lexicon_table import score_by_lexicon_table
from hearsay.operators.rule_table import anchor, label_by_rule_table
from hearsay.settings import CATEGORY_RULES

TEXTS = [
    None, "", " \t", "They UNVEILED a thing, v2.5 is next", "Relaunching is no launch", "announcements only", "a price  hike; a price hike",
    "İPO news and ſupply", "how we self-hosted it", "open source OPEN-SOURCE", "bandwidth ban", "x_beta beta_x", "βετας ΒΕΤΑΣ straße STRASSE",
    "the sue, the suet", "1.5 million", "fine tuned", "fine-tuning the model", "ship's ships", "café CAFÉ", "no rule fits here",
]


def rules_frame(spark, rules):
    flat = [(i, name, j, p) for i, (name, ps) in enumerate(rules) for j, p in enumerate(ps)]
    return spark.createDataFrame(flat, "rule_order int, category string, pattern_order int, pattern string")


@pytest.mark.parametrize(("pattern", "key"), [
    (r"\blaunch(?:e[sd]|ing)?\b", "p:launch"), (r"\bgeneral availability\b", "w:availability"), (r"\bnow available\b", "w:available"),
    (r"\bbuilt?\b", "p:buil"), (r"\bv?\d+\.\d+\b", None), (r"\bhow (?:to|i|we)\b", "w:how"), (r"\bopen[- ]source\b", "p:open"),
    (r"launch", None), (r"\bCEO\b", "w:ceo"), (r"\ba|b\b", None), (r"\b(?:a|b)\b", None), (r"(?i)\bx\b", None), (r"\bx{2}y\b", None),
    (r"^start\b", "w:start"), (r"\blong+er\b", "p:long"), (r"\bone\.two\b", "w:two"), (r"\bone\\two\b", "w:two"), (r"\bé+té\b", "p:é"),
    (r"\bfoo(?!bar)\w*\b", "p:foo"), (r"\bunbelievably\w*", "p:unbeliev"), (r"\bab*c\b", "p:a"), (r"\b[ab]c\b", None), (r"\b\x41b\b", None),
])
def test_anchor(spark, pattern, key):
    assert spark.range(1).select(anchor(F.lit(pattern))).first()[0] == key


@pytest.mark.parametrize("small", [True, False])
def test_rule_table_equals_rules_in_the_plan(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(rule_table, "BROADCAST_ROWS", 0)
    rules = [("greek", [r"\bβετας\b"]), ("street", [r"\bstraße\b", "ſtr"]), ("loose", [r"\d\.\d million", "CAF(?:É)"]),
             *CATEGORY_RULES, ("late", [r"\bIPO\b", r"\bsupply\b", r"\w+_x$"])]
    texts = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], "id long, text string, category_ string")
    texts = texts.union(texts.where("id in (0, 5, 6)")).union(spark.createDataFrame([(None, t, "c") for t in TEXTS], texts.schema))
    got = label_by_rule_table(texts, rules_frame(spark, rules), key=("id",))
    assert got.columns == [*texts.columns, "category", "matched_term"]
    label = category_rules(F.col("text"), rules)
    want = texts.select("*", label["category"].alias("category"), label["matched_term"].alias("matched_term"))
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(got) == key(want)


def test_rule_table_limits(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "word9999 here"), (2, "word3 word7")], "id long, text string")
    many = spark.range(20_000).select(
        F.col("id").cast("int").alias("rule_order"), F.concat(F.lit("c"), "id").alias("category"), F.lit(0).alias("pattern_order"),
        F.concat(F.lit(r"\bword"), "id", F.lit(r"\b")).alias("pattern"))
    got = {r["id"]: (r["category"], r["matched_term"]) for r in label_by_rule_table(texts, many).collect()}
    assert got == {1: ("c9999", "word9999"), 2: ("c3", "word3")}
    assert label_by_rule_table(texts, many.limit(0)).where("category = 'other' and matched_term is null").count() == 2
    assert label_by_rule_table(texts.limit(0), many).count() == 0
    plan = label_by_rule_table(texts, many)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    monkeypatch.setattr(rule_table, "MAX_LOOSE", 2)
    with pytest.raises(ValueError, match="more than 2 patterns"):
        label_by_rule_table(texts, rules_frame(spark, [("x", ["a", "b", "c"])]))


@pytest.mark.parametrize("small", [True, False])
def test_rules_that_are_met_later(spark, monkeypatch, small):
    """Few rules are met first; texts that match none of these meet the rest, in whole rule order."""
    monkeypatch.setattr(rule_table, "FIRST_RULES", 2)
    monkeypatch.setattr(rule_table, "FIRST_SHARE", 0.0)
    if not small:
        monkeypatch.setattr(rule_table, "BROADCAST_ROWS", 4)
    rules = [(0, "loose", 0, r"\d\.\d million"), (1, "late loose", 9, "CAF(?:É)"), (None, "unplaced", 3, r"\bunveiled\b"), (1, "ban", None, r"\bban\b"),
             (1, "tie", 2, r"\bprice\b"), (1, "a tie", 2, r"\bprice\b"), (-5, "early", 1, r"\bnews\b"), (7, "last", 0, r"\bthing\b"), (7, "last", 1, r"\bsuet?\b")]
    rules = spark.createDataFrame(rules, "rule_order int, category string, pattern_order int, pattern string")
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    found = label_by_rule_table(texts, rules, key=("id",))
    in_order = [("unplaced", [r"\bunveiled\b"]), ("early", [r"\bnews\b"]), ("loose", [r"\d\.\d million"]), ("ban", [r"\bban\b"]),
                ("a tie", [r"\bprice\b"]), ("late loose", ["CAF(?:É)"]), ("last", [r"\bthing\b", r"\bsuet?\b"])]
    label = category_rules(F.col("text"), in_order)
    want = texts.select("*", label["category"].alias("category"), label["matched_term"].alias("matched_term"))
    assert sorted(found.collect(), key=str) == sorted(want.collect(), key=str)
    assert want.where("category <> 'other'").count() >= 6
    # Two joins with candidates: of the early rules for all texts, of the others for what is left.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") >= 2


SENTENCES = [
    None, "", " ", "Good, no really GOOD but not great!!!", "It is no good or bad??? no", "the bomb was at least bad", "VERY good very bad",
    "without doubt good", "never so good", "kind of good", "good good good " * 300, "yeah right, to die for", "nothing here", "GOOD BAD",
]


@pytest.mark.parametrize("small", [True, False])
def test_lexicon_table_equals_lexicon_in_the_plan(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(lexicon_table, "BROADCAST_ROWS", 0)
    real = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    words = STARTER_LEXICON | {"the": 0.5, "de": -1.5, "und": 0.0}
    rows = [(i, t, 0.0) for i, t in enumerate(SENTENCES + real)]
    texts = spark.createDataFrame([*rows, rows[3], rows[3], (None, SENTENCES[3], 0.0), (None, "bad", 0.0)], "id long, text string, word double")
    table = [*words.items(), ("good", -4.0), ("bad", None), (None, 1.0)]
    got = score_by_lexicon_table(texts, spark.createDataFrame(table, "word string, score double"), key=("id",))
    assert got.columns == [*texts.columns, "score"]
    want = texts.select("*", lexicon_score(F.col("text"), words).alias("score"))
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(got) == key(want)


def test_lexicon_above_the_literal_limit(spark):
    table = spark.range(60_000).select(F.concat(F.lit("w"), "id").alias("word"), ((F.col("id") % 9 - 4) / 2).alias("score"))
    texts = spark.createDataFrame([(1, "w8 w59997"), (2, "w60000"), (3, "w0")], "id long, text string")
    got = {r["id"]: r["score"] for r in score_by_lexicon_table(texts, table).collect()}
    assert got[2] == 0.0 and got[1] > 0 > got[3]
    assert score_by_lexicon_table(texts.limit(0), table).count() == score_by_lexicon_table(texts, table.limit(0)).where("score <> 0").count() == 0


def test_large_lexicon_moves_rare_words_alone(spark, monkeypatch):
    monkeypatch.setattr(lexicon_table, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(lexicon_table, "SAMPLE_TEXTS", 4)
    words = STARTER_LEXICON | {"the": 0.5, "held": 1.0}
    texts = spark.createDataFrame([(i, f"the held thing is good number{i} the {'not bad' if i % 3 else 'awful'}") for i in range(40)], "id long, text string")
    got = score_by_lexicon_table(texts, spark.createDataFrame(list(words.items()), "word string, score double"), key=("id",))
    want = texts.select("*", lexicon_score(F.col("text"), words).alias("score"))
    assert sorted(got.collect()) == sorted(want.collect())
    # The lexicon is not copied, neither to the executors nor, if it looks small, to the driver.
    plan = got._jdf.queryExecution().toString()
    assert "_salt" not in plan and "sequence(0" not in plan
    low = texts.select(F.col("id").alias("_k1"), F.split("text", " ").alias("_low"))
    frequent = {r["word"] for r in lexicon_table.frequent_words(low).collect()}
    assert len(frequent) == 3 and "the" in frequent


def test_report_state_follows_labels(spark, tmp_path):
    rng = random.Random(4)
    schema = ("id string, topic string, title string, text string, url string, created_at timestamp, points bigint, "
              "sentiment string, sentiment_score double, category string")
    label = lambda: rng.choice([(None, None, None), ("positive", rng.randrange(100) / 100, "a"), ("negative", -0.35, None), ("neutral", 0.01, "b")])
    base = [(f"m{i}", rng.choice("xyz") if i % 11 else None, None if i % 3 else f"t{i}", "long text " * 20, "u", None if i % 7 == 0 else f"2024-01-0{i % 5 + 1}",
             None if i % 5 == 0 else i % 13) for i in range(120)]
    now = {b[0]: label() for b in base}
    counts, items = f"{tmp_path}/counts", f"{tmp_path}/items"
    frame = lambda ids: spark.createDataFrame(
        [(*b, *now[b[0]]) for b in base if b[0] in ids], schema.replace("created_at timestamp", "created_at string")
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    seen = set()
    for batch in range(3):
        fresh = {b[0] for i, b in enumerate(base) if i % 3 == batch}
        came, went = frame(fresh), None
        report_state.best_items(frame(fresh), 5).write.parquet(f"{items}/batch={batch}")
        if seen:
            before = frame(seen)
            before = spark.createDataFrame(before.collect(), before.schema)
            change = {i: label() for i in rng.sample(sorted(seen), 25)}
            new = spark.createDataFrame([(i, *v) for i, v in change.items()], "id string, sentiment string, sentiment_score double, category string")
            more, went = report_state.relabelled(before, new)
            now |= change
            came = came.select(*more.columns).unionByName(more)
        report_state.count_changes(came, went).write.parquet(f"{counts}/batch={batch}")
        seen |= fresh
    whole = frame(seen)
    state = report_state.merge_counts(spark.read.parquet(counts))
    rows = lambda f: [tuple(r) for r in f.collect()]
    assert rows(report_state.sentiment_by_topic(state)) == rows(report.sentiment_by_topic(whole))
    assert rows(report_state.category_distribution(state)) == rows(report.category_distribution(whole))
    assert rows(report_state.headline_counts(state, 4)) == [(120, 3, 4, whole.where("sentiment is null or category is null").count())]
    assert rows(report_state.distinct_topics(state)) == rows(report.distinct_topics(whole))
    best = report_state.top_items(spark.read.parquet(items), whole.select("id", "sentiment", "category"), 5)
    assert sorted(map(str, rows(best))) == sorted(map(str, rows(report.top_items_per_topic(whole, 5).select(*best.columns))))
    # Compaction and repeated batches of items change nothing.
    assert sorted(map(str, rows(report_state.merge_counts(state)))) == sorted(map(str, rows(state)))
    twice = spark.read.parquet(items).unionByName(spark.read.parquet(items))
    assert report_state.merge_items(twice, 5).count() == best.count()
    for plan in (state, best):
        assert "long text" not in plan._jdf.queryExecution().toString() and "text:string" not in plan._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="keep 100"):
        report_state.top_items(spark.read.parquet(items), whole, 101)
