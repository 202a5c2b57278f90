"""Words of whole Arrow batches as 64-bit hashes, without a Python loop over words.

Texts lie end to end in an Arrow string column. Word borders are found on the
bytes of a whole slice at once, and each word gets a polynomial hash from prefix
sums, finished by a mixing step. Letters A-Z hash like a-z. Two different words
of a corpus share a hash with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    return values


BYTE_VALUES = _byte_values()
# White space of the word contract, and everything that is no letter (for stripped words).
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NON_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, size: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < size:
        base = _BASE if name == "up" else pow(_BASE, -1, 2**64)
        steps = np.full(size, base & (2**64 - 1), np.uint64)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text begins (one more entry than texts). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_borders(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = SPACES) -> tuple[np.ndarray, ...]:
    """Starts and ends of all words, and where each text's words begin in them."""
    inside = ~gaps[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    inner = bounds[:-1][bounds[:-1] < len(data)]
    starts[inner] = inside[inner]
    last = bounds[1:][bounds[1:] > 0] - 1
    ends[last] = inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _PIECE, "right"))
        if j <= i:  # one very long word
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes().lower())
            i += 1
            continue
        base = starts[i]
        piece = data[base : ends[j - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[piece] * _power("up", len(piece)), out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        raw = (sums[b] - sums[a]) * _power("down", len(piece))[a]
        out[i:j] = mix(raw + (b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        i = j
    return out


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about `limit` bytes (one long text may have more)."""
    if not batch.num_rows:
        return
    bounds = text_bytes(batch.column(text))[1]
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def hashed_words(texts: pa.Array, gaps: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and where each text's words begin."""
    data, bounds = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts, ends, first = word_borders(data, bounds, gaps)
    return word_hashes(data, starts, ends), first


def shares(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Per text the number of bytes in a set (a 256-entry mask)."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(member[data], out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
