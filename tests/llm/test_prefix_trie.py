"""Prefix trie against a plain version, with nulls, ties, repeated rows, turnless and very long conversations."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import hearsay.llm.prefix_trie as module
from hearsay.llm.ordered import running
from hearsay.llm.prefix_trie import prefix_trie, rebuilt


@pytest.fixture(autouse=True)
def several_partitions(spark):
    """Small tables stay in several partitions, so that borders are crossed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain(rows, block=100, heads=6):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            talks[conv].append((turn is not None, turn or 0, role, mark, text))
    talks = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in talks.items()}
    whole = {}
    for c in talks:
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = tuple(talks.get(c - c % block, [])[:h] + talks[c][h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    return Counter(
        (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(who) if whole[c] == node).encode()).hexdigest())
        for node, who in members.items()
    )


def table(spark, rows):
    # Extra columns bear names that the operator uses itself.
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "conv_id long, turn long, role string, text string, depth int, k1 string, part int")


EDGES = [
    *[(c, t, "user" if t % 2 == 0 else "bot", f"{(c * 7 + t) % 3}") for c in range(40) for t in range(c % 9)],
    (100, None, None, None), (100, 0, "user", ""), (100, 0, "user", ""), (100, 0, "bot", "b"), (100, 0, "bot", "a"),
    (101, 3, "user", "only"), (205, 0, "user", "no base"), (206, 0, "user", "no base"), (None, 0, "user", "lost"),
    (None, 1, "bot", "lost"), (300, 0, None, "é" * 5000), (301, 0, "", "é" * 5000), (-150, 1, "user", "minus"), (-100, 1, "u", "m"),
    *[(c, t, "user", "same") for c in range(400, 440) for t in range(7)],
]


def test_trie_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(module, "PIECE", 3)
    got = prefix_trie(*rebuilt(table(spark, EDGES)))
    assert Counter(tuple(r) for r in got.collect()) == plain(EDGES)


def test_hot_parents_and_a_very_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT", 2)
    rows = [(c, 0, "user", "hello") for c in range(60)] + [(c, 1, "bot", f"answer {c}") for c in range(60)]
    rows += [(c, t, "bot", f"{t % 50}") for c in (7, 8) for t in range(2, 700)]
    got = prefix_trie(*rebuilt(table(spark, rows).repartition(5)))
    assert Counter(tuple(r) for r in got.collect()) == plain(rows)


def test_empty_table(spark):
    assert prefix_trie(*rebuilt(table(spark, EDGES).limit(0))).count() == 0
    assert prefix_trie(*rebuilt(table(spark, [(None, 1, "a", "b")]))).count() == 0


@pytest.mark.parametrize("hot", [0, 900])
def test_running_crosses_partitions(spark, hot):
    keys = [None if i % 50 == 3 else 0 if i < hot else i % 40 for i in range(1000)]
    frame = spark.createDataFrame([(k, i, i * i) for i, k in enumerate(keys)], "g long, o long, v long")
    got = running(frame, "g", ["o"], {"s": ("sum", "v"), "x": ("bit_xor", "v")}, "test")
    assert got.columns == ["g", "o", "v", "s", "x"]
    sums, xors = Counter(), Counter()
    for r in sorted(got.collect(), key=lambda r: r["o"]):
        sums[r["g"]] += r["v"]
        xors[r["g"]] ^= r["v"]
        assert (r["s"], r["x"]) == (sums[r["g"]], xors[r["g"]])
    if hot:
        parts = got.inputFiles()
        assert len(parts) > 1 and got.where("g = 0").agg(F.max("s")).first()[0] == sums[0]
