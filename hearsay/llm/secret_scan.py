"""Secret scan: fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over characters are trained, one of random strings,
one of ordinary runs of letters and digits. Labels are not given ones: the values
that the patterns find are the samples of random strings, and every run of
`MIN_RUN` or more outside pattern spans is a sample of ordinary ones. So secrets
that the patterns miss are among the ordinary samples too; they are few against
the words and numbers of a corpus, and differ from each other. Counts are
aggregated over all documents.

Candidates are all runs of `MIN_RUN` or more token characters in the parts of a
text that no pattern span covers, whatever they are made of. One is a secret when
its log-likelihood ratio reaches `threshold`. Half of the random model is uniform,
so alphabets unseen in training still count as random.

Offsets are code points, end exclusive; spans are sorted by start, then kind.
Defined results: a null or empty text has no spans; without any training string
both models are uniform and nothing is added; ties and repeated rows are scanned
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.llm.words import slices

KINDS = ("assign", "access", "hex", "markov")
MIN_RUN, THRESHOLD = 8, 10.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
EDGE = len(ALPHABET)

# The pattern contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # maximal runs: a run of 16 or more, or none
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
ORDINARY = re.compile(r"[A-Za-z0-9_]{%d,}" % MIN_RUN)

_CODE = {c: i for i, c in enumerate(ALPHABET)}


def codes(text: str) -> list[int]:
    return [EDGE, *(_CODE.get(c, EDGE) for c in text), EDGE]


def pattern_spans(text: str) -> tuple[list[tuple[int, int, int]], list[str]]:
    """Spans (start, kind number, end) of the fixed patterns, and the secret strings in them."""
    spans, values = [], []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 8:
            spans.append((m.start(), 0, m.end()))
            values.append(m[2])
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        for m in pattern.finditer(text):
            spans.append((m.start(), kind, m.end()))
            values.append(m[0])
    return spans, values


def uncovered(size: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a text that no span covers, in order."""
    at = 0
    for start, _, end in sorted(spans):
        if start > at:
            yield at, start
        at = max(at, end)
    if size > at:
        yield at, size


def transition_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(model, before, after, n) over all documents; model 1: random strings, 0: ordinary runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans, values = pattern_spans(text)
                for value in values:
                    c = codes(value)
                    found.update((1, a, b) for a, b in zip(c, c[1:], strict=False))
                for start, end in uncovered(len(text), spans):
                    for m in ORDINARY.finditer(text, start, end):
                        c = codes(m[0])
                        found.update(zip((0,) * len(c), c, c[1:], strict=False))
        rows = [(*k, n) for k, n in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["model", "before", "after", "n"]
        )

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = texts.mapInArrow(run, "model long, before long, after long, n long")
    return counts.groupBy("model", "before", "after").agg(F.sum("n").alias("n"))


def ratio_table(counts: DataFrame, smoothing: float = 0.5) -> np.ndarray:
    """Log of the random over the ordinary transition probability. Reads at most 2 * 69 * 69 rows."""
    tables = np.zeros((2, EDGE + 1, EDGE + 1))
    for model, before, after, n in counts.collect():
        tables[model, before, after] = n
    tables += smoothing
    tables /= tables.sum(axis=2, keepdims=True)
    return np.log(0.5 * tables[1] + 0.5 / (EDGE + 1)) - np.log(tables[0])


def markov_spans(text: str, spans: list[tuple[int, int, int]], ratio: np.ndarray, threshold: float) -> list:
    added = []
    for start, end in uncovered(len(text), spans):
        for m in RUN.finditer(text, start, end):
            c = codes(m[0])
            if ratio[c[:-1], c[1:]].sum() >= threshold:
                added.append((m.start(), 3, m.end()))
    return added


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    ratio: np.ndarray | None = None,
) -> DataFrame:
    """doc_id and spans: array of (kind, start, end). `ratio` may hold a table trained elsewhere."""
    if ratio is None:
        ratio = ratio_table(transition_counts(docs, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = []
                for text in part.column(1).to_pylist():
                    spans, _ = pattern_spans(text)
                    spans += markov_spans(text, spans, ratio, threshold)
                    found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")
