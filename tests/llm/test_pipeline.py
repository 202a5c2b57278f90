"""The whole pipeline against a plain version on a table with planted copies, and each stage on edge rows."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hearsay.llm.oracle import ORACLE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def near_classes(rows):
    """Smallest id reachable by links of five-word shingles at 0.8."""
    sets = {}
    for i, text in rows.items():
        w = words(text)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    again = True
    while again:
        again = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    again = True
    return root


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest table with planted exact copies, near copies, and texts that the base rule rejects."""
    path = tmp_path_factory.mktemp("sf")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).collect()]
    good = [r for r in rows if len(r[1].split()) > 60][:6]
    planted = [(9000 + k, r[1].upper() if k % 2 else r[1], r[2], r[3], r[4]) for k, r in enumerate(good)]
    planted += [(9100 + k, r[1] + " one more word", r[2], r[3], r[4]) for k, r in enumerate(good)]
    planted += [(9200, "too short", "en", rows[0][3], 9), (9201, "spam spam " * 40, "en", rows[0][3], 400), (9202, "", "en", "x", 0),
                (9203, None, None, None, None)]
    spark.createDataFrame(rows + planted, SCHEMA).coalesce(1).write.parquet(f"{path}/documents.parquet")
    return str(path), {r[0]: r for r in rows + planted}


def test_run_equals_plain(spark, folder):
    path, docs = folder
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    cursor = con.execute(f"select doc_id from ({ORACLE['op4_quality_rules']}) where kept")
    kept = {i for (i,) in cursor.fetchall()}
    assert kept and not kept & {9200, 9201, 9202, 9203}
    last = {}
    for i in kept:
        text = " ".join(docs[i][1].split(" "))
        key = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
        last[key] = max(last.get(key, i), i)
    unique = set(last.values())
    assert len(unique) < len(kept)
    root = near_classes({i: docs[i][1] for i in unique})
    final = {i for i in unique if root[i] == i}
    assert len(final) < len(unique)

    got = corpus_pipeline.run(spark, path).collect()
    times = Counter(r["doc_id"] for r in got)
    assert set(times) == final
    # Mixing reads every document once, and sources of too small a share up to twice.
    assert max(times.values()) <= 2
    by_source = {}
    for i, n in times.items():
        by_source.setdefault(docs[i][3], set()).add(n)
    whole = [s for s, n in by_source.items() if n == {1}]
    assert whole and all(n <= {1, 2} for n in by_source.values())
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    for r in got:
        want = library.encode(docs[r["doc_id"]][1], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stage_on_edges(spark, folder, stage):
    name, function = stage
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (None, text + " null id", "en", "s", 1),
            (None, None, None, None, None), (3, "", "en", "s", 0), (4, "é" * 30_000 + " " + text * 60, None, "t", 9)]
    # Extra columns bear names that the stages use themselves.
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", copy int, __key string")
    got = function(spark, docs, folder[0])
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
    ids = Counter(r["doc_id"] for r in got.collect())
    if name == "quality rules":
        assert ids == Counter({1: 2, None: 1}) or ids == Counter({1: 2, None: 1, 4: 1})
    elif name == "exact dedup":
        # Null and empty texts are equal; of equal rows of one id one stays.
        assert ids == Counter({1: 1, 3: 1, None: 1, 4: 1})
    elif name == "n-gram Jaccard join":
        # 4 and the row without id but with words are near copies of 1: they share 36 of 42 and of 38 shingles.
        assert ids == Counter({1: 2, 2: 1, 3: 1, None: 1})
    else:
        assert set(ids) == {1, 2, 3, 4, None}
    assert function(spark, docs.limit(0), folder[0]).count() == 0
