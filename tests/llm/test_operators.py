"""Each operator on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import checks.compare as compare
from hearsay.llm.bpe import bpe_round_trip, decode_ids
from hearsay.llm.exact_dedup import drop_exact_copies, exact_dedup, merge_runs
from hearsay.llm.hmm_scoring import Hmm, emissions, expected_counts, first_shares, hmm_scoring, log_likelihoods
from hearsay.llm.mixing import mix_sources, mixed_documents
from hearsay.llm.ngram_join import ngram_join, one_per_component
from hearsay.llm.oracle import ORACLE
from hearsay.llm.quality_rules import keep_good, quality_rules
from hearsay.llm.queries import QUERIES, URL_RULES, labelled_urls
from hearsay.llm.secret_scan import pattern_spans, ratio_table, secret_scan, transition_counts
from hearsay.llm.site_quality import site_quality
from hearsay.llm.toxicity import score_chain, train_chain
from hearsay.llm.url_filter import url_filter
from hearsay.llm.words import hashed_words

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BASE = " ".join(f"word{i}" for i in range(120))
TEXTS = [
    "Alpha beta gamma", "alpha BETA gamma", None, "", " \t\n ", "É é alpha", BASE, BASE + " tail", BASE.upper(),
    "ö" * 3000 + " " + "x" * 70_000, "one two", "one two", "İstanbul ΣΑΣ \x1c<|endoftext|> it's 123!!",
    'token = "0123456789abcdef0123456789abcdef" end', "AKIA" + "Z" * 16 + " kq8Zr1xW9pLm3Tn7Vb2Yc4",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, "n", 0) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "no id here", "en", "s0", "n", 0)]
    # Extra columns bear names that the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n string, copy int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(14)], "doc_id long, good int, t boolean").select(
        "doc_id", "good", F.col("t").cast("int").alias("toxic")
    )


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_exact_dedup(docs):
    got = exact_dedup(docs).collect()
    assert len(got) == docs.count()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for r in got:
        text = low(dict(rows)[r["doc_id"]])
        same = [i for i, t in rows if low(t) == text]
        best = max((i for i in same if i is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best, len(same), r["doc_id"] == best)
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({low(t) for _, t in rows})


def test_exact_dedup_merges_sorted_runs(spark):
    """Many runs, binary rounds, and half of all rows equal; rounds deal by range and merge in order."""
    rows = [(i, "Same text" if i % 2 else f"t{i % 30}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    for largest in (True, False):
        best, size = {}, Counter()
        for i, t in rows:
            best[t] = (max if largest else min)(best.get(t, i), i)
            size[t] += 1
        got = exact_dedup(table, fan_in=2, largest=largest).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == Counter(
            (i, best[t], size[t], best[t] == i) for i, t in rows)
    runs = spark.range(10).selectExpr("id as run", "cast(cast(id as string) as binary) as digest", "id as n_bytes", "id as keep_id", "id as group_size")
    plan = merge_runs(runs, 2)._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert "rangepartitioning(run" in plan and "SortAggregate" in plan and "HashAggregate" not in plan and plan.count("Exchange ") == 1


def test_quality_rules(docs):
    got = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert got[2]["n_words"] == 0 and got[2]["base_failed"] and not got[2]["kept"]
    assert got[6]["n_words"] == 120 and got[6]["n_repeat_words"] == 0
    assert set(keep_good(docs).columns) == set(docs.columns)
    repeated = docs.sparkSession.createDataFrame([(1, "a b c d e x a b c d e f a b c d e f g", "en", "s")],
                                                 "doc_id long, text string, lang string, source string")
    # a..e at 0, 6, 12; b c d e f and its windows at 7 and 13 join them.
    assert quality_rules(repeated).first()["n_repeat_words"] == 5 + 6 + 6


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    assert compare.compare(spark, compare.connect(SF), SF, name) is None


def brute_components(rows, size, num, den):
    sets = {}
    for i, t in rows:
        w = words(low(t))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and den * both >= num * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (len(s), root[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
def test_ngram_join(spark, docs, size, num):
    known = docs.where("doc_id is not null")
    real = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    table = known.select("doc_id", "text").union(real)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join(table, size, num, 100).collect()}
    assert got == brute_components([(r["doc_id"], r["text"]) for r in table.collect()], size, num, 100)
    assert one_per_component(docs).columns == docs.columns


def test_ngram_join_through_rows_without_id(spark):
    """Rows without an id link others, take their names, and of a component without any id one row stays."""
    words_of = [f"w{i}" for i in range(60)]
    # Neighbours share 56 of 60 shingles, the first and the last 54 of 62.
    texts = {k: " ".join(words_of[k:] + [f"x{i}" for i in range(k)]) for k in (0, 2, 4)}
    alone = " ".join(f"y{i}" for i in range(50))
    rows = [(5, texts[0], "a"), (None, texts[2], "b"), (1, texts[4], "c"), (None, alone, "d"), (None, alone + " z", "e"),
            (None, None, "f"), (None, "", "g"), (2, None, "h")]
    table = spark.createDataFrame(rows, "doc_id long, text string, __node string").repartition(3)
    for frame, name in ((table, int), (table.withColumn("doc_id", F.col("doc_id").cast("string")), str)):
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join(frame, 3, 90, 100).collect())
        one, five, two = map(name, (1, 5, 2))
        assert got == Counter([(five, 58, one), (None, 58, one), (one, 58, one), (None, 48, None), (None, 49, None),
                               (None, 0, None), (None, 0, None), (two, 0, two)])
        kept = sorted(r["__node"] for r in one_per_component(frame, size=3, num=90).collect())
        assert kept in ([*"cdfgh"], [*"cefgh"])


def test_hmm_scoring(docs):
    known = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r["doc_id"]: [*words(low(r["text"])), None] for r in known.collect()}
    held = {i for i in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    count = Counter(w for i, ws in rows.items() if i not in held for w in ws)
    total, distinct = sum(count.values()), len(count)
    # Few frequent words, so that the join path is used too.
    got = by_id(hmm_scoring(known, states=2, frequent=6, passes=2))
    for i, ws in rows.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (i in held, len(ws), sum(count[w] > 0 for w in ws))
        assert r["train_tokens"] == total and abs(r["base_score"] - base) < 1e-6 and r["score"] < 0


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(3)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    hmm = Hmm(share(rng.random(2)), share(rng.random(2)), share(rng.random((2, 2))), share(rng.random((2, 4))))
    texts = [np.array(t, np.uint16) for t in ([0, 1, 3], [3], [2, 2, 1, 0, 3])]
    for text, got in zip(texts, log_likelihoods(texts, hmm), strict=True):
        total = 0.0
        for path in np.ndindex(*(2,) * len(text)):
            p = hmm.start[path[0]] * hmm.emit[path[0], text[0]]
            for a, b, o in zip(path, path[1:], text[1:], strict=False):
                p *= hmm.move[a, b] * hmm.emit[b, o]
            total += p
        assert abs(got - math.log10(total)) < 1e-9


def test_expected_counts_cross_segment_borders():
    rng = np.random.default_rng(5)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    hmm = Hmm(share(rng.random(2)), share(rng.random(2)), share(rng.random((2, 2))), share(rng.random((2, 4))))
    texts = [np.array(t) for t in ([0, 1, 3], [3], [2, 2, 1, 0, 3, 1, 2])]
    want = [np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))]
    for text in texts:
        paths = {}
        for path in np.ndindex(*(2,) * len(text)):
            p = hmm.start[path[0]] * hmm.emit[path[0], text[0]]
            for a, b, o in zip(path, path[1:], text[1:], strict=False):
                p *= hmm.move[a, b] * hmm.emit[b, o]
            paths[path] = p
        for path, p in paths.items():
            p /= sum(paths.values())
            want[0][path[0]] += p
            for a, b in zip(path, path[1:], strict=False):
                want[1][a, b] += p
            for a, o in zip(path, text, strict=True):
                want[2][o, a] += p
    for steps in (None, 1, 2, 3):
        for got, right in zip(expected_counts(texts, hmm, steps), want, strict=True):
            assert np.allclose(got, right)


def test_every_training_word_has_its_own_emissions(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: words(low(r["text"])) for r in table.collect()}
    train = [i for i in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    names = sorted({w for i in train for w in rows[i]})
    at = {w: k for k, w in enumerate(names)}
    end, new = len(names), len(names) + 1
    texts = {i: np.array([*[at.get(w, new) for w in ws], end]) for i, ws in rows.items()}
    count = np.bincount(np.concatenate([texts[i] for i in train]), minlength=new + 1)
    shares = np.vstack([first_shares(hashed_words(pa.array(names))[0], 3), np.full((2, 3), 1 / 3)])
    seen, even = count[:, None] * shares, np.full(3, 1 / 3)
    hmm = Hmm(even, seen.sum(axis=0), np.full((3, 3), 0.1) + 0.7 * np.eye(3), None)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    hmm.emit = emissions(seen, hmm.tokens, new).T
    for _ in range(2):
        start, pairs, seen = expected_counts([texts[i] for i in train], hmm)
        hmm = Hmm(share(start + 0.1), seen.sum(axis=0), share(pairs + 0.1), emissions(seen, seen.sum(axis=0), new).T)
    assert np.allclose(hmm.emit.sum(axis=1), 1)
    want = dict(zip(texts, log_likelihoods(list(texts.values()), hmm), strict=True))
    # Nearly all words are outside the frequent ones and come by the join.
    for i, r in by_id(hmm_scoring(table, states=3, frequent=50, passes=2)).items():
        assert abs(r["score"] - want[i]) < 1e-3 * abs(want[i])


def test_hmm_beats_unigram_on_held_out_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, model = hmm_scoring(table).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base


def test_secret_scan(docs):
    got = by_id(secret_scan(docs))
    assert [tuple(s) for s in got[13]["spans"]] == [("assign", 0, 41), ("hex", 9, 41)]
    assert got[2]["spans"] == [] and got[3]["spans"] == []
    assert got[14]["spans"][0]["kind"] == "access"
    assert pattern_spans("password: short passwd='longenough1'")[0] == [(16, 0, 35)]


def test_markov_models_add_random_strings(spark, docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratio = ratio_table(transition_counts(real, "text"))
    got = by_id(secret_scan(docs, ratio=ratio))
    assert [s["kind"] for s in got[14]["spans"]] == ["access", "markov"]
    assert [s["kind"] for s in got[13]["spans"]] == ["assign", "hex"]


def test_bpe(docs):
    library = Tokenizer.from_file(VOCABULARY)
    coded = bpe_round_trip(docs, VOCABULARY)
    again = by_id(decode_ids(coded.select("doc_id", "ids"), VOCABULARY))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for i, r in by_id(coded).items():
        want = library.encode(texts[i], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False) == again[i]["decoded"]


def test_mixing(docs):
    got = mix_sources(docs, max_repetition=2.0, block_tokens=64)
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    copies = Counter((r["source"], r["copy"]) for r in rows)
    assert max(c for _, c in copies) <= 1
    per_block = Counter((r["block"], r["position"]) for r in rows)
    assert max(per_block.values()) == 1
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == mix_sources(docs, max_repetition=2.0).count()


def test_mixing_meets_targets(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix_sources(table, max_repetition=1.5)
    own = table.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    read = rows.groupBy("source").count().join(own, "source")
    assert read.where("count < n").isEmpty() and read.where("count > 2 * n").isEmpty()
    weights = [r["weight"] for r in mix_sources(table, max_repetition=None, target_entropy=2.5).select(
        "source", "weight").distinct().collect()]
    assert abs(-sum(w * math.log(w) for w in weights) - 2.5) < 1e-3


def test_sharp_target_entropy_loses_no_document(spark):
    rows = [(i, "a b c d e f g h i j", "abc"[(i >= 50) + (i >= 90)]) for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(table, max_repetition=None, target_entropy=0.8).collect()
    assert {r["doc_id"] for r in got if r["copy"] == 0} == set(range(100))
    read = Counter(r["source"] for r in got)
    assert read["c"] == 10
    for r in got:
        assert abs(read[r["source"]] / len(got) - r["weight"]) < 0.02


def test_weights_too_sharp_ask_for_a_budget(spark):
    rows = [(i, "a " * (200 if i else 1), "x" if i else "y") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="budget"):
        mix_sources(table, max_repetition=None, target_entropy=1e-7)
    got = mix_sources(table, max_repetition=None, target_entropy=1e-7, budget_tokens=23_600).groupBy("doc_id").count()
    assert got.where("doc_id > 0 and count <> 2").isEmpty()


def test_rows_without_tokens_are_dealt_over_blocks(spark):
    table = spark.createDataFrame(
        [(i, None if i < 300 else "a b c d", "x" if i < 300 else "y") for i in range(400)],
        "doc_id long, text string, source string")
    for frame, size in ((table, 400), (table.where("doc_id < 300"), 300)):
        rows = mix_sources(frame, block_tokens=64).collect()
        assert len(rows) == size
        assert max(Counter(r["block"] for r in rows if r["source"] == "x").values()) <= 100


def test_site_quality(docs, labels):
    got = site_quality(docs, labels, host_col="source", path_col="lang").collect()
    assert len(got) == docs.count() and all(0 <= r["p_good"] <= 1 for r in got)


def test_classifiers_on_held_out_labels(spark):
    path = "/root/testdata/sf0.01"
    table, marks = (spark.read.parquet(f"{path}/{n}.parquet") for n in ("documents", "labels"))
    train, test = marks.where("doc_id % 3 > 0"), marks.where("doc_id % 3 = 0")
    good = site_quality(table, train.select("doc_id", F.col("quality").alias("good")), host_col="source", path_col="lang")
    right = good.join(test, "doc_id").agg(F.avg((F.col("good") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.9
    chain = train_chain(table, train.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic"), ["junk", "toxic"])
    toxic = score_chain(table, chain).select("doc_id", (F.col("p_toxic") >= chain.cuts[1]).alias("called"))
    right = toxic.join(test, "doc_id").agg(F.avg((F.col("called") == (F.col("toxic") == 1)).cast("int"))).first()[0]
    assert right > 0.9


def test_toxicity_edges(docs, labels):
    chain = train_chain(docs, labels, ["good", "toxic"])
    assert score_chain(docs, chain).count() == docs.count()


def test_url_filter(spark):
    urls = ["http://A.Example.com/en/1", "https://www.example.com/en/2", "x.net/es/", None, "http://b.net/es/3?x=1&y=2",
            "http://net/fr/", "http://c.org", "HTTP://evil.biz/q1w2e3r4t5/9876543210?a=1&b=2"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labelled = spark.createDataFrame(
        [(f"http://good{i}.org/news/story", 0) for i in range(60)]
        + [(f"http://x.biz/{10**9 + 7919 * i}?a=1&b={i}", 1) for i in range(60)], "url string, label int")
    got = {r["page_id"]: r for r in url_filter(pages, labelled, URL_RULES).collect()}
    assert [got[i]["rule"] for i in range(8)] == [
        "example.com/en/", "www.example.com/en/", None, None, "net/es/", "net/fr/", None, None]
    assert got[0]["host"] == "a.example.com" and got[0]["verdict"] == "block" and got[1]["verdict"] == "allow"
    assert (got[2]["host"], got[2]["path"]) == ("", "") and got[6]["path"] == ""
    assert got[6]["verdict"] == "allow" and got[7]["verdict"] == "block"
    none = url_filter(pages, labelled.limit(0), URL_RULES)
    assert none.where("rule is null and verdict = 'block'").isEmpty()


def test_labels_reach_every_url_ending(spark):
    ends = ["", "/", ".html", "#top", "?page=2", "?page=2&ref=x"]
    urls = [f"https://h{i}.example.com/de/{i}{end}" for i, end in enumerate(ends, 10)]
    other = ["http://12.example.com", "http://a.net/en/x?id=/12", "http://a.net/en/#/12", None]
    pages = spark.createDataFrame([(u,) for u in [*urls, *other]], "url string")
    labels = spark.createDataFrame([(i, 1, int(i == 12)) for i in range(10, 16)], "doc_id long, quality int, toxic int")
    got = {tuple(r) for r in labelled_urls(pages, labels).collect()}
    assert got == {(u, int(i == 12)) for i, u in enumerate(urls, 10)}


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    frames = [
        exact_dedup(none), drop_exact_copies(none), quality_rules(none), keep_good(none), ngram_join(none),
        one_per_component(none), hmm_scoring(none), secret_scan(none), bpe_round_trip(none, VOCABULARY),
        mix_sources(none), mixed_documents(none), site_quality(none, labels, host_col="source", path_col="lang"),
        score_chain(none, train_chain(none, labels, ["good", "toxic"])),
        url_filter(spark.createDataFrame([], "page_id long, url string"),
                   spark.createDataFrame([], "url string, label int"), URL_RULES),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
