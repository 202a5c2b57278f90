"""Importance resampling towards a target: exact weights from bit-sliced counts.

Features of a text are its runs of 1 to `max_run` consecutive words, hashed into
`buckets`. Counts over all documents and over all target texts give each bucket
an integer gain. A document's bucket counts are then laid out as bit planes (bit
j of every bucket's count), and so are the gains (sign and magnitude). The sum of
count times gain is the sum, over pairs of planes, of the popcount of their AND
times a power of two: integers, so weights are exact and equal on any machine.

Each task adds up its own bucket counts, so the shuffle carries one row per task
and bucket, and the driver reads `buckets` rows at every corpus size. Scoring is
narrow. Documents are drawn with Gumbel noise from a seeded hash of their id; the
ranks of the drawn come from counts by score (scores are whole thousandths of a
logarithm, so their number is bounded) and an order within each score.

Defined results: null and empty texts have no features and weight 0; a null id
takes the noise of an empty id and comes first among ties; repeated rows count
each, and each may be drawn; ties of score go to the smaller id, then to fewer
features; empty documents give an empty result; without target texts all gains
rest on the smoothing alone; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearsay.llm.common import stage
from hearsay.llm.words import slices, text_bytes, word_borders

BUCKETS = 10_000
# Rows whose planes are held at once, and words that are hashed in step up to this length.
ROWS, LONG_WORD = 64, 256
# Letters, digits and everything outside ASCII make words; A-Z counts as a-z.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1)
    return values


CRC = _crc_table()


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of every slice data[start:end]: all slices in step, very long ones alone."""
    out = np.zeros(len(starts), np.uint32)
    size = ends - starts
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= LONG_WORD]
    begin, state = starts[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    live = np.searchsorted(-size[order], -np.arange(int(size[order].max(initial=0))), "left")
    for step, rows in enumerate(live.tolist()):
        now = state[:rows]
        state[:rows] = CRC[(now ^ data[begin[:rows] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def feature_buckets(texts: pa.Array, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all features end to end: their row and bucket; and each row's number of words."""
    data, bounds = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    data = LOWER[data]
    starts, ends, first = word_borders(data, bounds, GAPS)
    words = np.diff(first)
    row = np.repeat(np.arange(len(texts)), words)
    if max_run > 1:  # words end to end, each with one space behind it
        size = ends - starts
        begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(begin, size) + inside] = data[np.repeat(starts, size) + inside]
        data, starts, ends = joined, begin, begin + size
    rows, found = [], []
    for n in range(1, max_run + 1):
        at = np.flatnonzero(row[: max(len(row) - n + 1, 0)] == row[n - 1 :])
        rows.append(row[at])
        found.append(run_checksums(data, starts[at], ends[at + n - 1]).astype(np.int64) % buckets)
    return np.concatenate(rows), np.concatenate(found), words


def bucket_counts(texts: DataFrame, max_run: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows of a one-column frame; the driver reads at most `buckets` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(feature_buckets(part.column(0), max_run, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floored 1000-fold log ratio of the smoothed shares in target and source."""
    every_s, every_t, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((t + 1) * (every_s + buckets) / ((s + 1) * (every_t + buckets))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    rows = np.packbits(bits, axis=1)
    return np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the gains' magnitudes, those of positive gains first, and each plane's signed power of two."""
    planes, values = [], []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for k in range(int(size.max(initial=0)).bit_length()):
            planes.append(size >> k & 1)
            values.append(sign << k)
    if not planes:
        return packed(np.zeros((1, len(gain)), bool)), np.zeros(1, np.int64)
    return packed(np.array(planes, bool)), np.array(values, np.int64)


def weighted_sums(row: np.ndarray, bucket: np.ndarray, rows: int, planes: np.ndarray, values: np.ndarray, buckets: int) -> np.ndarray:
    """Per row the exact sum of its features' gains, by AND and popcount of planes."""
    total = np.zeros(rows, np.int64)
    cell, count = np.unique(row * buckets + bucket, return_counts=True)
    for a in range(0, rows, ROWS):
        upto = min(a + ROWS, rows)
        lo, hi = np.searchsorted(cell, [a * buckets, upto * buckets])
        here, n = cell[lo:hi] - a * buckets, count[lo:hi]
        for j in range(int(n.max(initial=0)).bit_length()):
            bits = np.zeros((upto - a) * buckets, bool)
            bits[here[n >> j & 1 == 1]] = True
            plane = packed(bits.reshape(-1, buckets))
            met = np.stack([np.bitwise_count(plane & p).sum(axis=1, dtype=np.int64) for p in planes], axis=1)
            total[a:upto] += (met @ values) << j
    return total


def noise(doc_id: object, seed: str) -> int:
    """Floored 1000-fold Gumbel noise from the seeded hash of an id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_scores(
    docs: DataFrame, target: DataFrame, max_run: int = 1, buckets: int = BUCKETS, seed: str = "2024",
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain of the features), score (weight and noise)."""
    whole = lambda frame, c: frame.select(F.coalesce(F.col(c), F.lit("")).alias("text"))
    gain = gains(*(bucket_counts(whole(f, c), max_run, buckets) for f, c in ((docs, text_col), (target, target_col))))
    planes, values = gain_planes(gain)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                row, bucket, words = feature_buckets(part.column(1), max_run, buckets)
                n = np.bincount(row, minlength=part.num_rows)
                sums = weighted_sums(row, bucket, part.num_rows, planes, values, buckets)
                weight = sums // np.maximum(n, 1)
                drawn = np.array([noise(i, seed) for i in part.column(0).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(v.astype(np.int64)) for v in (words, n, weight, weight + drawn))],
                    names=["doc_id", "n_words", "n_features", "weight", "score"],
                )

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long, score long")


def ranked_draw(scored: DataFrame, may: str, percent: int) -> DataFrame:
    """`scored` with a `rank`: 1, 2, 3.. for the floor(percent N / 100) best of the N rows that `may` holds for.

    Counts by score give the cut and every score's first rank; the order by id is
    made within each score.
    """
    able = scored.where(may)
    counts = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pydict()
    drawn = percent * sum(counts["n"]) // 100
    firsts, before = [], 0
    for score, n in sorted(zip(counts["score"], counts["n"], strict=True), reverse=True):
        if before >= drawn:
            break
        firsts.append((score, before))
        before += n
    none = scored.withColumn("rank", F.lit(None).cast("long"))
    if not firsts:
        return none
    cut = firsts[-1][0]
    first = scored.sparkSession.createDataFrame(
        pa.table({"score": pa.array([f[0] for f in firsts], pa.int64()), "before": pa.array([f[1] for f in firsts], pa.int64())})
    )
    place = F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features"))
    best = able.where(F.col("score") >= cut).join(F.broadcast(first), "score").withColumn("rank", place + F.col("before"))
    best = best.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = none.where(~F.coalesce(F.expr(may), F.lit(False)) | (F.col("score") < cut))
    return best.select(*none.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, **options,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: the share of the documents of `min_words` or more with the best scores."""
    scored = stage(importance_scores(docs, target, **options), "importance")
    return ranked_draw(scored, f"n_words >= {int(min_words)}", percent).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
