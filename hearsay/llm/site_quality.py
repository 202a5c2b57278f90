"""Quality classifier that shares evidence within sites, by hierarchical empirical Bayes.

A logistic model on text features gives each document a probability of being
good. Grouped sums of these (or of the labels, where there are any) give the
corpus, every host and every path of a host a rate of good documents. A host's
rate is shrunk toward the corpus, a path's toward its host, by prior strengths
estimated from how far groups differ beyond chance: sparse sites take their
parent's rate, large ones keep their own. A document's own vote is left out of
its site's rate. The document's evidence (its log odds over the training rate)
is then added to the log odds of its site.

The classifier is fitted on a bounded sample of at most `max_labelled` labelled
documents; rates cover all documents.

Defined results: a null or empty text has no words and is judged by its features
like any other; null host or path is a group of its own; without labels of both
classes the text gives no evidence; of several labels for an id the greater
counts; repeated rows count each and are judged
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.llm.common import join_small, stage
from hearsay.llm.linear import SAMPLE_ROWS, fit_logistic, labelled_sample
from hearsay.llm.words import hashed_words, shares, slices, text_bytes

_BYTES = np.arange(256)
MASKS = {
    "upper": np.isin(_BYTES, list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    "digit": np.isin(_BYTES, list(b"0123456789")),
    "symbol": np.isin(_BYTES, list(b"#*$%&<>")),
    "bar": _BYTES == ord("|"),
    "shout": _BYTES == ord("!"),
    "mark": np.isin(_BYTES, list(b".,;:?")),
    "line": _BYTES == ord("\n"),
}
N_FEATURES = 2 * len(MASKS) + 4


def text_features(texts: pa.Array) -> np.ndarray:
    """Shares of characters (and whether they are high), length, word length, repeated words."""
    data, bounds = text_bytes(texts)
    hashes, first = hashed_words(texts)
    size, n = np.maximum(np.diff(bounds), 1), np.diff(first)
    cells = []
    for mask in MASKS.values():
        percent = 100.0 * shares(data, bounds, mask) / size
        cells += [np.minimum(percent, 20.0), np.log1p(percent)]
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    distinct = np.bincount(d[new], minlength=len(n))
    full = np.maximum(n, 1)
    cells += [np.log1p(n), np.minimum(size / full, 30.0), distinct / full, np.minimum(n, 20) / 20.0]
    return np.stack(cells, axis=1)


def with_features(rows: DataFrame, text_at: int, schema: str, finish) -> DataFrame:
    """mapInArrow helper: `finish(part, features)` makes the output arrays."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_at):
                yield pa.RecordBatch.from_arrays(finish(part, text_features(part.column(text_at))), names=names)

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_labelled: int) -> tuple[np.ndarray, float]:
    """Weights over the raw features (constant last), and the rate of good documents in the sample."""
    known = labels.select("doc_id", F.col("good").cast("int").alias("good")).dropna()
    sample = labelled_sample(docs, known, id_col, text_col, max_labelled).select("text", "good")
    rows = with_features(
        sample, 0, "x binary, good int",
        lambda part, x: [pa.array([r.tobytes() for r in x], pa.binary()), part.column(1)],
    )
    # Bounded by max_labelled rows.
    found = sorted((bytes(x), good) for x, good in rows.collect())
    y = np.array([good for _, good in found], float)
    rate = float(y.mean()) if len(y) else 0.0
    if not 0 < rate < 1:
        return np.zeros(N_FEATURES + 1), 0.5
    x = np.array([np.frombuffer(b, float) for b, _ in found])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    w = fit_logistic((x - mean) / spread, y)
    raw = w[:-1] / spread
    return np.append(raw, w[-1] - raw @ mean), rate


def group_rates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("vote").alias("s"))


def prior_strength(groups: DataFrame, parent: Column) -> float:
    """Pseudo-counts of the parent's rate, by the method of moments.

    The variance of group rates around the parent is split into chance
    (rate * (1 - rate) / n) and true spread; the strength is rate * (1 - rate)
    over the true spread, less one.
    """
    inside = parent * (1 - parent)
    big = groups.where("n >= 2")
    noise, spread, weight = big.agg(
        F.sum(inside), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - parent, F.lit(2))), F.sum("n")
    ).first()
    level, n = groups.agg(F.sum(inside * F.col("n")), F.sum("n")).first()
    if not weight or not n:
        return 10.0
    true = max((spread - noise) / weight, 1e-6)
    return float(min(max(level / n / true - 1.0, 2.0), 1e5))


def log_odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(safe) - F.ln(1 - safe)


def site_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "host",
    path_col: str = "path", threshold: float = 0.5, max_labelled: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, host, path, p_text, host_rate, path_rate, p_good, good. `labels` has doc_id and good (0/1)."""
    weights, base = train(docs, labels, id_col, text_col, max_labelled)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    id_type = dict(rows.dtypes)["doc_id"]
    scored = with_features(
        rows, 3, f"doc_id {id_type}, host string, path string, z double",
        lambda part, x: [*part.columns[:3], pa.array(np.clip(x @ weights[:-1] + weights[-1], -8, 8))],
    )
    p = 1 / (1 + F.exp(-F.col("z")))
    known = labels.select(F.col("doc_id").alias("l"), F.col("good").cast("double").alias("label")).dropna()
    known = known.groupBy("l").agg(F.max("label").alias("label"))
    scored = stage(scored.withColumn("p_text", p), "scored")
    votes = scored.join(known, scored["doc_id"] == known["l"], "left").withColumn(
        "vote", F.coalesce("label", "p_text")
    ).drop("l", "label")
    votes = stage(votes, "votes")
    paths = stage(group_rates(votes, ["host", "path"]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("s") / F.sum("n")).first()[0]
    rate = F.lit(float(total if total is not None else 0.5))
    k_host = prior_strength(hosts, rate)
    hosts = stage(hosts.withColumn("host_rate", (F.col("s") + k_host * rate) / (F.col("n") + k_host)), "hosts")
    sites = join_small(paths, hosts.select("host", "host_rate"), ["host"])
    k_path = prior_strength(sites, F.col("host_rate"))
    judged = join_small(votes, stage(sites, "sites"), ["host", "path"])
    # The document's own vote is taken out of its site.
    others = (F.col("s") - F.col("vote") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    odds = F.col("z") - log_odds(F.lit(base)) + log_odds(F.col("path_rate"))
    return judged.withColumn("path_rate", others).withColumn("p_good", 1 / (1 + F.exp(-odds))).select(
        "doc_id", "host", "path", "p_text", "host_rate", "path_rate", "p_good",
        (F.col("p_good") >= threshold).alias("good"),
    )
