"""Learning and mixing operators against plain versions on whole small tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from hearsay.llm.linear import fit_logistic, labelled_sample, logit, sigmoid
from hearsay.llm.mixing import mix_sources
from hearsay.llm.queries import URL_RULES, op1_url_filter, op6_secret_scan
from hearsay.llm.secret_scan import EDGE, codes, markov_spans, pattern_spans, ratio_table, secret_scan, transition_counts, uncovered
from hearsay.llm.site_quality import site_quality
from hearsay.llm.toxicity import Chain, Design, features, fit_chain, fit_sparse
from hearsay.llm.url_filter import FEATURES, train, url_filter
from hearsay.llm.words import NON_LETTERS, hashed_words

SF = "/root/testdata/sf0.001"


def test_url_rules_on_the_whole_table(spark):
    got = {r["page_id"]: r for r in op1_url_filter(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        at = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", page["url"])
        host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), at[1]), at[2]) if at else ("", "")
        best = None
        for rule in URL_RULES:
            name, start = rule.rule.split("/", 1)
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(rule.rule) > len(best.rule if best else ""):
                best = rule
        r = got[page["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best.rule if best else None)
        assert r["verdict"] == (best.verdict if best else "block" if r["score"] > 0 else "allow")


def test_url_trees_as_a_column_equal_the_model(spark):
    rng = random.Random(2)
    rows = [(*(float(rng.randrange(9)) for _ in FEATURES), i % 2 if rng.random() < 0.3 else int(i % 5 > 2)) for i in range(300)]
    sample = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES) + ", label int")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=5, maxDepth=3, stepSize=0.3, seed=7).fit(data)
    for r in model.transform(data).withColumn("margin", train(sample, rounds=5)).collect():
        assert abs(r["rawPrediction"][1] - r["margin"]) < 1e-9


def test_urls_of_any_length_and_repeated(spark):
    urls = ["http://a.com/" + "x/" * 20_000 + "?" + "k=v&" * 5_000, "http://a.com/1", "http://a.com/1", "", "://", "http://"]
    pages = spark.createDataFrame([(i, u, "s") for i, u in enumerate(urls)], "page_id long, url string, suffix string")
    got = url_filter(pages, spark.createDataFrame([("http://a.com/1", 1), ("http://b.com/2", 0)], "url string, label int"), URL_RULES).collect()
    by_id = {r["page_id"]: r for r in got}
    assert len(got) == 6 and by_id[1]["verdict"] == by_id[2]["verdict"] == "allow" and by_id[1]["rule"] == "com/"
    assert len(by_id[0]["path"]) == 40_001 and by_id[4]["host"] == by_id[5]["host"] == ""


def test_mixing_follows_its_weights(spark):
    rng = random.Random(8)
    sizes = {"big": 400, "mid": 120, "low": 40, None: 10}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * rng.randrange(1, 60), source))
            i += 1
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens, size = Counter(), {}
    for doc, text, source in rows:
        size[doc] = len(text.split())
        tokens[source] += size[doc]
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}
    least, most = min(share.values()), max(share.values())
    low, high = 0.0, 1.0
    for _ in range(60):  # the flattest weights that read the smallest source at most three times
        a = (low + high) / 2
        low, high = (a, high) if (least / most) ** (a - 1) > 3 else (low, a)
    z = sum(p**high for p in share.values())
    budget = total * most ** (1 - high) * z
    got = mix_sources(table, max_repetition=3.0, block_tokens=500).collect()
    read, blocks, seen = Counter(), defaultdict(Counter), Counter()
    for r in got:
        assert abs(r["weight"] - share[r["source"]] ** high / z) < 1e-6
        read[r["source"]] += r["n_tokens"]
        blocks[r["block"]][r["source"]] += r["n_tokens"]
        seen[r["doc_id"]] += 1
    for source in sizes:
        want = share[source] ** high / z * budget
        assert abs(read[source] - want) <= 60
        passes = want / tokens[source]
        counts = {seen[d] for d, _, s in rows if s == source}
        assert counts <= {math.floor(passes + 1e-6), math.ceil(passes - 1e-6)} and min(counts) >= 1
    # Whole passes come first: every document of a source is read before any is read again.
    for doc in size:
        copies = sorted(r["copy"] for r in got if r["doc_id"] == doc)
        assert copies == list(range(len(copies)))
    # Each block holds the sources in the target proportion, within a document.
    for block, own in blocks.items():
        whole = budget / len(blocks)
        assert abs(own["big"] - share["big"] ** high / z * whole) <= 120, block
    places = Counter((r["block"], r["position"]) for r in got)
    assert max(places.values()) == 1


def plain_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda f: (f[1], ("assign", "access", "hex").index(f[0])))


def test_secret_scan_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ratio = ratio_table(transition_counts(docs, "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in op6_secret_scan(spark, SF).collect():
        base = plain_spans(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for k, _, _ in base) for n in ("assign", "access", "hex")]
        spans = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert [s for s in spans if s[0] != "markov"] == [(k, str(a), str(b)) for k, a, b in base]
        added = [(int(a), int(b)) for k, a, b in spans if k == "markov"]
        covered = [(a, b) for _, a, b in base]
        want = []
        for m in re.finditer("[A-Za-z0-9+/_=-]+", "".join("\n" if any(a <= i < b for a, b in covered) else c for i, c in enumerate(texts[r["doc_id"]]))):
            c = codes(m[0])
            if len(m[0]) >= 8 and sum(ratio[x, y] for x, y in zip(c, c[1:], strict=False)) >= 10:
                want.append((m.start(), m.end()))
        assert added == want


def test_secret_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "token = aaaabbbb and abababab"), (2, None)], "doc_id long, text string")
    counts = {(r["model"], r["before"], r["after"]): r["n"] for r in transition_counts(docs, "text").collect()}
    a, b = codes("ab")[1:3]
    assert counts == {(1, EDGE, a): 1, (1, a, a): 3, (1, a, b): 1, (1, b, b): 3, (1, b, EDGE): 1,
                      (0, EDGE, a): 1, (0, a, b): 4, (0, b, a): 3, (0, b, EDGE): 1}
    ratio = ratio_table(transition_counts(docs, "text"))
    n = EDGE + 1
    random_share, plain_share = (3 + 0.5) / (4 + 0.5 * n), 0.5 / (4 + 0.5 * n)
    assert abs(ratio[a, a] - math.log((0.5 * random_share + 0.5 / n) / plain_share)) < 1e-12


def test_short_and_one_kind_runs_are_judged(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratio = ratio_table(transition_counts(real, "text"))
    texts = ["key kq8Zr1xW9pLm3Tn7V end", "kqXzrLxWvpLmWTnQVbYcWzPq", "xK9$ password: Zx81kQ0wPq and internationalization representative"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secret_scan(docs, ratio=ratio).collect()}
    assert got[0] == [("markov", 4, 21)] and got[1] == [("markov", 0, 24)] and [k for k, _, _ in got[2]] == ["assign"]


def test_many_spans_take_linear_time():
    text = "password = abcdefgh12 x_identifier_y " * 40_000
    spans, _ = pattern_spans(text)
    assert len(spans) == 40_000 and len(list(uncovered(len(text), spans))) == 40_000
    assert markov_spans(text, spans, np.zeros((EDGE + 1, EDGE + 1)), 1.0) == []


def test_site_rates_by_hand(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["good", "text", "bad", "###"]) for _ in range(30)), f"h{i % 3}", f"p{i % 2}") for i in range(60)]
    labels = [(i, int(i % 3 == 0 or i % 5 == 0)) for i in range(0, 60, 2)] + [(0, 0), (None, 1), (1, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, host string, path string")
    got = {r["doc_id"]: r for r in site_quality(frame, spark.createDataFrame(labels, "doc_id long, good int")).collect()}
    known = defaultdict(list)
    for i, good in labels:
        if i is not None and good is not None:
            known[i].append(good)
    vote = {i: float(max(known[i])) if known.get(i) else got[i]["p_text"] for i in got}

    def strength(groups, parents):
        noise = spread = weight = level = n = 0.0
        for g, own in groups.items():
            m, s, p = len(own), sum(own), parents[g]
            level, n = level + p * (1 - p) * m, n + m
            if m >= 2:
                noise, spread, weight = noise + p * (1 - p), spread + m * (s / m - p) ** 2, weight + m
        true = max((spread - noise) / weight, 1e-6)
        return min(max(level / n / true - 1.0, 2.0), 1e5)

    hosts, paths = defaultdict(list), defaultdict(list)
    for i, _, h, p in docs:
        hosts[h].append(vote[i])
        paths[h, p].append(vote[i])
    rate = sum(vote.values()) / len(vote)
    k = strength(hosts, dict.fromkeys(hosts, rate))
    host_rate = {h: (sum(v) + k * rate) / (len(v) + k) for h, v in hosts.items()}
    k = strength(paths, {g: host_rate[g[0]] for g in paths})
    for i, _, h, p in docs:
        own = (sum(paths[h, p]) - vote[i] + k * host_rate[h]) / (len(paths[h, p]) - 1 + k)
        assert abs(got[i]["host_rate"] - host_rate[h]) < 1e-9 and abs(got[i]["path_rate"] - own) < 1e-9
        assert got[i]["good"] == (got[i]["p_good"] >= 0.5)


def design(rng, n=300, words=12):
    rows, cells = np.nonzero(rng.random((n, words)) < 0.3)
    return Design(rows, cells, words, rng.normal(size=(n, 3)))


def test_sparse_fit_equals_dense_fit():
    rng = np.random.default_rng(1)
    x = design(rng)
    dense = np.zeros((300, 12))
    dense[x.rows, x.words] = 1
    dense = np.hstack([dense, x.dense])
    y = (rng.random(300) < sigmoid(dense @ rng.normal(size=15))).astype(float)
    used = np.arange(300) % 4 > 0
    want = fit_logistic(dense[used], y[used])
    for start in (None, rng.normal(size=16)):
        assert np.abs(fit_sparse(x, y, used.astype(float), start) - want).max() < 2e-3
    assert np.allclose(x.dot(want), dense @ want[:-1] + want[-1])
    u = rng.normal(size=300)
    assert np.allclose(x.back(u), np.append(u @ dense, u.sum())) and np.allclose(x.squares(u), np.append(u @ dense**2, u.sum()))


def test_chain_by_hand():
    rng = np.random.default_rng(4)
    x, fold = design(rng), np.arange(300) % 5
    y = (rng.random((300, 2)) < 0.4).astype(float)
    chain = fit_chain(x, y, fold, ["a", "b"], np.zeros(12, np.uint64))
    # The second link has seen the first one's out-of-fold probabilities, never a document's own label.
    unseen = np.zeros(300)
    for k in range(5):
        unseen[fold == k] = sigmoid(x.dot(fit_sparse(x, y[:, 0], (fold != k).astype(float))))[fold == k]
    want = fit_sparse(x.wider(logit(unseen)), y[:, 1], np.ones(300))
    assert np.abs(chain.weights[1] - want).max() < 5e-3
    first = sigmoid(x.dot(chain.weights[0]))
    second = sigmoid(x.wider(logit(first)).dot(chain.weights[1]))
    assert np.allclose(chain.probabilities(x), np.stack([first, second], axis=1))
    constant = fit_chain(x, np.stack([np.ones(300), y[:, 1]], axis=1), fold, ["a", "b"], np.zeros(12, np.uint64))
    assert constant.weights[0] is None and (constant.probabilities(x)[:, 0] == 1).all()
    assert isinstance(chain, Chain)


def test_several_labels_of_an_id(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, 0, 0), (None, 1, 1), (9, 1, 1)], "doc_id long, a int, b int")
    got = {tuple(r) for r in labelled_sample(docs, labels, "doc_id", "text", 10).select("doc_id", "text", "a", "b").collect()}
    assert got == {(1, "a", 1, 1), (2, "b", 0, 0)}


@pytest.mark.parametrize("text", ["", "word", "WORD word!"])
def test_features_hold_a_word_once(text):
    words = np.sort(hashed_words(pa.array(["word other"]), NON_LETTERS)[0])
    x = features(pa.array([text, None, "other word other"]), words)
    assert Counter(x.rows.tolist()) == Counter({0: int("word" in text.lower()), 2: 2}) - Counter({0: 0})
