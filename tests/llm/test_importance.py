"""Importance resampling against a plain version, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hearsay.llm.importance import feature_buckets, gain_planes, importance_scores, resample, weighted_sums

LONG = "x" * 70_000
TEXTS = [
    "Alpha beta, gamma beta", None, "", " \t-- ", "Éa éa alpha", "word " * 30, "beta " * 25 + LONG, "a1_b2", "İ ß \x85 z",
    *[" ".join(f"w{(i * k) % 17}" for k in range(20 + i)) for i in range(30)],
]


def features(text, max_run):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(found[i : i + n]) for n in range(1, max_run + 1) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) for r in runs]


def plain(rows, target, max_run, buckets, percent):
    parts = [(i, *features(t, max_run)) for i, t in rows]
    s = Counter(c % buckets for _, _, f in parts for c in f)
    t = Counter(c % buckets for x in target for c in features(x, max_run)[1])
    every_s, every_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every_s + buckets) / ((s[b] + 1) * (every_t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in parts:
        weight = sum(gain[c % buckets] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    ranks = Counter()
    for k, r in enumerate(able[: percent * len(able) // 100]):
        ranks[(r[0], r[2], r[3], r[4], k + 1)] += 1
    drawn = Counter((k[0], k[1], k[2], k[3]) for k in ranks.elements())
    for r in out:
        key = (r[0], r[2], r[3], r[4])
        if drawn[key]:
            drawn[key] -= 1
        else:
            ranks[(*key, None)] += 1
    return ranks


@pytest.mark.parametrize(("max_run", "buckets", "percent"), [(1, 10_000, 10), (3, 97, 60), (2, 64, 100)])
def test_resample_equals_plain(spark, max_run, buckets, percent):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [rows[20], rows[20], (None, TEXTS[25]), (None, TEXTS[25]), (None, None)]
    # Extra columns bear names that the operator uses itself.
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], "doc_id long, text string, score string, rank int, n long")
    target = [None, "", "beta w3 w5 w7 Alpha", "w1 " * 40]
    got = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, 20, max_run=max_run, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == plain(rows, target, max_run, buckets, percent)


def test_planes_give_the_plain_sum():
    rng = np.random.default_rng(7)
    gain = rng.integers(-9_000, 9_000, 70)
    row, bucket = np.sort(rng.integers(0, 150, 20_000)), rng.integers(0, 70, 20_000)
    want = np.bincount(row, gain[bucket], 150).astype(np.int64)
    assert (weighted_sums(row, bucket, 150, *gain_planes(gain), 70) == want).all()
    assert (weighted_sums(row, bucket, 150, *gain_planes(gain * 0), 70) == 0).all()


def test_checksums_are_crc32():
    row, bucket, words = feature_buckets(pa.array(TEXTS), 2, 2**32)
    for i, text in enumerate(TEXTS):
        n, want = features(text, 2)
        assert words[i] == n and sorted(bucket[row == i].tolist()) == sorted(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20), (2, "c " * 30)], "doc_id long, text string")
    assert resample(none, some).count() == 0 and resample(none, none).count() == 0
    assert [r["rank"] for r in resample(some, none, percent=50).orderBy("rank").collect()] == [None, 1]
    assert importance_scores(some, none).where("n_words = 30 and n_features = 30").count() == 1
