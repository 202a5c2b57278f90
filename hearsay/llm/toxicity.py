"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a linear model on the text
features and the probabilities of the categories before it. In training those
earlier probabilities are out-of-fold: a document's come from models that have
not seen it. Features are the presence of the words most associated with a
category (by z-score of their document frequencies among labelled documents), all
that reach `MIN_DOCS` documents and `MIN_Z`, and a few shares of character kinds.

The models are fitted on a bounded sample: at most `max_labelled` labelled
documents with the smallest hash of their id. All documents are scored whole.

Defined results: a null or empty text has no words and scores by the constants;
a category without both classes in the sample has a constant probability; null
labels are left out; of several labels for an id the greater counts, category by
category; repeated rows score alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.llm.common import stage
from hearsay.llm.linear import SAMPLE_ROWS, labelled_sample, logit, sigmoid
from hearsay.llm.words import NON_LETTERS, hashed_words, shares, slices, text_bytes

MIN_DOCS, MIN_Z, FOLDS = 5, 4.0, 5
KINDS = {
    "upper": np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    "digit": np.isin(np.arange(256), list(b"0123456789")),
    "symbol": np.isin(np.arange(256), list(b"#*$%&|<>")),
    "shout": np.isin(np.arange(256), list(b"!?")),
}


def style(texts: pa.Array, n_words: np.ndarray) -> np.ndarray:
    """Shares of character kinds (percent, capped at 30) and the logarithm of the length."""
    data, bounds = text_bytes(texts)
    size = np.maximum(np.diff(bounds), 1)
    cells = [np.minimum(100.0 * shares(data, bounds, m) / size, 30.0) for m in KINDS.values()]
    return np.stack([*cells, np.log1p(n_words)], axis=1)


@dataclass
class Design:
    """Rows of features: the words that a row holds, as pairs (row, word), then dense columns, then a constant."""

    rows: np.ndarray
    words: np.ndarray
    n_words: int
    dense: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        n = self.n_words
        return np.bincount(self.rows, w[:n][self.words], len(self.dense)) + self.dense @ w[n:-1] + w[-1]

    def back(self, u: np.ndarray) -> np.ndarray:
        """The transposed product."""
        return np.concatenate([np.bincount(self.words, u[self.rows], self.n_words), u @ self.dense, [u.sum()]])

    def squares(self, u: np.ndarray) -> np.ndarray:
        """The transposed product of the squared features."""
        return np.concatenate([np.bincount(self.words, u[self.rows], self.n_words), u @ self.dense**2, [u.sum()]])

    def wider(self, column: np.ndarray) -> Design:
        return Design(self.rows, self.words, self.n_words, np.hstack([self.dense, column[:, None]]))


def features(texts: pa.Array, words: np.ndarray) -> Design:
    """Presence of each of the sorted word hashes, then the style columns."""
    hashes, first = hashed_words(texts, NON_LETTERS)
    cells = np.zeros(0, np.int64)
    if len(words) and len(hashes):
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        hit = np.flatnonzero(words[at] == hashes)
        cells = np.unique((np.searchsorted(first, hit, "right") - 1) * len(words) + at[hit])
    size = max(len(words), 1)
    return Design(cells // size, cells % size, len(words), style(texts, np.diff(first)))


def fit_sparse(
    x: Design, y: np.ndarray, used: np.ndarray, start: np.ndarray | None = None, l2: float = 1.0, steps: int = 50,
) -> np.ndarray:
    """Logistic weights of the `used` rows with an L2 penalty, whose optimum is one, wherever the search starts.

    Newton steps, damped, each solved by conjugate gradients as far as it pays: to a
    hundredth of the gradient, which steps make smaller until it is next to nothing.
    """
    w = np.zeros(x.n_words + x.dense.shape[1] + 1) if start is None else start.copy()
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-3
    norm = lambda v: np.sqrt(v @ v)

    def loss(w: np.ndarray) -> float:
        z = x.dot(w)
        return used @ (np.logaddexp(0, z) - y * z) + 0.5 * (penalty * w) @ w

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x.dot(w))
        curve = used * np.maximum(p * (1 - p), 1e-6)
        rest = slope = x.back(used * (p - y)) + penalty * w
        if norm(rest) < 1e-4 * np.sqrt(used.sum() + 1):
            break
        scale = 1 / (x.squares(curve) + penalty)
        step, limit = np.zeros(len(w)), 0.01 * norm(rest)
        along = scale * rest
        size = rest @ along
        for _ in range(100):
            bent = x.back(curve * x.dot(along)) + penalty * along
            pace = size / (along @ bent)
            step, rest = step + pace * along, rest - pace * bent
            if norm(rest) <= limit:
                break
            z = scale * rest
            size, last = rest @ z, size
            along = z + size / last * along
        # Halved until the loss falls as it should: far from the optimum whole steps may overshoot.
        pace = 1.0
        while (then := loss(w - pace * step)) > now - 1e-4 * pace * (slope @ step) and pace > 1e-9:
            pace /= 2
        w, now = w - pace * step, then
    return w


def telling_words(sample: DataFrame, categories: list[str]) -> np.ndarray:
    """Sorted hashes of the words whose document frequency differs between the classes by MIN_Z or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                hashes, first = hashed_words(part.column(0), NON_LETTERS)
                marks = np.stack([part.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(categories))])
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                order = np.lexsort((hashes, doc))
                h, d = hashes[order], doc[order]
                once = np.ones(len(h), bool)
                once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                word, where = np.unique(h[once], return_inverse=True)
                counts = [np.bincount(where, minlength=len(word))]
                counts += [np.bincount(where, m[d[once]], len(word)) for m in marks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]],
                    names=["word", "n", *[f"n{i}" for i in range(len(categories))]],
                )

    columns = ", ".join(f"n{i} long" for i in range(len(categories)))
    counts = sample.select("text", *categories).mapInArrow(run, f"word long, n long, {columns}")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(categories))]
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), *sums).where(F.col("n") >= MIN_DOCS)
    totals = sample.agg(F.count(F.lit(1)), *[F.sum(c) for c in categories]).first()
    best = F.lit(0.0)
    for i, positive in enumerate(totals[1:]):
        rate = (positive or 0) / max(totals[0], 1)
        if 0 < rate < 1:
            expected = F.col("n") * rate
            best = F.greatest(best, F.abs(F.col(f"n{i}") - expected) / F.sqrt(expected * (1 - rate)))
    # At most the words of the bounded sample that MIN_DOCS of its documents hold.
    told = counts.withColumn("z", best).where(F.col("z") >= MIN_Z).select("word")
    return np.sort(np.array([r[0] for r in told.collect()], np.int64).view(np.uint64))


@dataclass
class Chain:
    """Categories, word features, weights of each link (None: a constant rate), cuts for a verdict."""

    categories: list[str]
    words: np.ndarray
    weights: list[np.ndarray | None]
    rates: list[float]
    cuts: list[float]

    def link(self, i: int, x: Design) -> np.ndarray:
        w = self.weights[i]
        return np.full(len(x.dense), self.rates[i]) if w is None else sigmoid(x.dot(w))

    def probabilities(self, x: Design) -> np.ndarray:
        out = []
        for i in range(len(self.categories)):
            out.append(self.link(i, x))
            x = x.wider(logit(out[-1]))
        return np.stack(out, axis=1)


def best_cut(p: np.ndarray, target: np.ndarray) -> float:
    """The probability from which a document counts as positive: best F1 out of fold, at least 0.2."""
    grid = np.arange(0.2, 0.801, 0.05)
    hits = np.array([((p >= c) & (target == 1)).sum() for c in grid])
    called = np.array([(p >= c).sum() for c in grid])
    f1 = 2 * hits / np.maximum(called + target.sum(), 1)
    return float(grid[int(f1.argmax())]) if f1.max() > 0 else 0.5


def fit_chain(x: Design, y: np.ndarray, fold: np.ndarray, categories: list[str], words: np.ndarray) -> Chain:
    chain = Chain(categories, words, [], [], [])
    for i in range(len(categories)):
        target = y[:, i]
        rate = float(target.mean()) if len(target) else 0.0
        chain.rates.append(rate)
        unseen = np.full(len(target), rate)
        if not 0 < rate < 1:
            chain.weights.append(None)
        else:
            chain.weights.append(fit_sparse(x, target, np.ones(len(target))))
            for k in range(FOLDS):
                own, rest = fold == k, fold != k
                if own.any() and 0 < target[rest].mean() < 1:
                    unseen[own] = sigmoid(x.dot(fit_sparse(x, target, rest.astype(float), chain.weights[-1])))[own]
        chain.cuts.append(best_cut(unseen, target))
        x = x.wider(logit(unseen))
    return chain


def train_chain(
    docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = SAMPLE_ROWS,
) -> Chain:
    """`labels` has doc_id and one 0/1 column per category, in chain order."""
    known = labels.select("doc_id", *[F.col(c).cast("int").alias(c) for c in categories]).dropna()
    sample = stage(labelled_sample(docs, known, id_col, text_col, max_labelled), "labelled")
    words = telling_words(sample, categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                x = features(part.column(1), words)
                own = np.split(x.words.astype(np.int32), np.searchsorted(x.rows, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.tobytes() for c in own], pa.binary()),
                     pa.array([r.tobytes() for r in x.dense], pa.binary()), *part.columns[2:]],
                    names=["doc_id", "words", "dense", *categories],
                )

    marks = ", ".join(f"{c} int" for c in categories)
    id_type = dict(sample.dtypes)["doc_id"]
    rows = sample.select("doc_id", "text", *categories).mapInArrow(run, f"doc_id {id_type}, words binary, dense binary, {marks}")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).alias("fold")
    # Bounded by max_labelled rows, each with the telling words it holds and a few numbers.
    found = rows.select("doc_id", "words", "dense", fold, *categories).orderBy("doc_id").collect()
    held = [np.frombuffer(r["words"], np.int32) for r in found]
    x = Design(
        np.repeat(np.arange(len(found)), [len(h) for h in held]).astype(np.int64),
        np.concatenate([np.zeros(0, np.int32), *held]).astype(np.int64), len(words),
        np.array([np.frombuffer(r["dense"]) for r in found], float).reshape(len(found), len(KINDS) + 1),
    )
    y = np.array([[r[c] for c in categories] for r in found], float).reshape(len(found), len(categories))
    return fit_chain(x, y, np.array([r["fold"] for r in found]), categories, words)


def score_chain(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and p_<category> of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                p = chain.probabilities(features(part.column(1), chain.words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(p[:, i]) for i in range(len(names))]], names=["doc_id", *names]
                )

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} double" for n in names))
