"""Costs and scaling of the hidden Markov model's passes."""

import numpy as np
import pytest

from hearsay.llm import hmm_scoring as hmm_module
from hearsay.llm.hmm_scoring import Hmm, expected_counts, hmm_scoring, log_likelihoods


def share(x):
    return x / x.sum(axis=-1, keepdims=True)


def sums_in_64_bits(texts, hmm):
    """Scaled at every step, text by text."""
    start, pairs, emit, scores = np.zeros(len(hmm.start)), np.zeros(hmm.move.shape), np.zeros(hmm.emit.T.shape), []
    for text in texts:
        shown = hmm.emit.T[text]
        alpha, scale = np.empty(shown.shape), np.empty(len(text))
        for t in range(len(text)):
            alpha[t] = (alpha[t - 1] @ hmm.move if t else hmm.start) * shown[t]
            scale[t] = alpha[t].sum()
            alpha[t] /= scale[t]
        beta = np.ones(len(hmm.start))
        for t in reversed(range(len(text))):
            emit[text[t]] += alpha[t] * beta
            if t:
                ahead = shown[t] * beta / scale[t]
                pairs += np.outer(alpha[t - 1], ahead) * hmm.move
                beta = hmm.move @ ahead
        start += alpha[0] * beta
        scores.append(np.log10(scale).sum())
    return start, pairs, emit, np.array(scores)


@pytest.mark.parametrize("least", [1e-11, 1e-6, 1e-2])
def test_seldom_scaling_is_right_for_rare_words_and_transitions(least):
    rng = np.random.default_rng(7)
    move = share(np.full((3, 3), least) + np.eye(3))
    # Words that only one state has, by turns: each step takes the rarest transition.
    emit = np.full((3, 40), 1e-10)
    emit[np.arange(36) % 3, np.arange(36)] = rng.random(36)
    hmm = Hmm(share(rng.random(3)), None, move, share(emit))
    texts = [np.arange(3000) % 3, rng.integers(0, 40, 2000), np.array([39]), np.array([5, 5, 39]), rng.integers(0, 40, 300)]
    start, pairs, sums, scores = sums_in_64_bits(texts, hmm)
    assert np.allclose(log_likelihoods(texts, hmm), scores, rtol=1e-9)
    for steps in (None, 1, 7, 500):
        for got, right in zip(expected_counts(texts, hmm, steps), (start, pairs, sums), strict=True):
            assert np.allclose(got, right, rtol=2e-3, atol=1e-4 * right.max())


def test_single_state_counts_words():
    hmm = Hmm(np.ones(1), None, np.ones((1, 1)), np.full((1, 4), 0.25))
    texts = [np.array([0, 1, 1, 3]), np.array([3])]
    start, pairs, emit = expected_counts(texts, hmm)
    assert np.allclose(start, 2) and np.allclose(pairs, 3) and np.allclose(emit[:, 0], [1, 2, 0, 2])


def test_sums_of_frequent_words_move_packed(spark, monkeypatch):
    """A pass writes rows by chunks and tasks, not one for each frequent word of each task."""
    rows = [(i, " ".join(f"w{(i * 7 + k) % 3000}" for k in range(400))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    written = []

    def counting(frame, name, *how, stage_by=hmm_module.stage_by):
        found = stage_by(frame, name, *how)
        written.append((name, found.count()))
        return found

    monkeypatch.setattr(hmm_module, "stage_by", counting)
    assert hmm_scoring(docs, states=2, frequent=2500, passes=2).count() == 100
    sums = [n for name, n in written if name == "sums"]
    assert len(sums) == 2 and max(sums) < 100
