"""BPE encoding and decoding with a public word-level vocabulary file.

A word's parts and the ranks of adjacent pairs lie in two contiguous arrays. The
rank array is scanned for its minimum, that boundary is deleted, and the two
neighbouring ranks are refreshed, until no pair has a rank. Words above
`SHORT_PARTS` parts take a heap over the same pairs, so a very long word does not
cost its length squared. Both pick the lowest rank, leftmost first.

Texts are split at special tokens, then at white space; a chunk between gaps is
normalised, split into words and encoded once per cache period, as no word
crosses a gap. Chunks outside ASCII are normalised and split by the
tokenizer library itself, whose Unicode tables decide.

Defined results: a null or empty text has no ids and decodes to the empty text;
ties and repeated rows are encoded alike; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hearsay.llm.words import slices

SHORT_PARTS = 96
CACHE_ENTRIES = 300_000
CACHED_LENGTH = 64
NO_RANK = 1 << 62
MASK = (1 << 20) - 1
# Below this letter the Unicode tables of all versions agree; above it the library's decide.
PLAIN_BELOW = "\u0530"

# The ASCII case of the vocabulary's word pattern.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
PLAIN_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[int, str]:
    """Bytes as printable letters: printable bytes stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """A vocabulary file, and its encoder and decoder."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.pieces = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for piece, i in vocab.items():
            self.pieces[i] = piece
        for token in spec["added_tokens"]:
            self.pieces[token["id"]] = token["content"]
        self.special = {t["content"]: np.uint32(t["id"]).tobytes() for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Pair of ids -> rank and merged id, each packed in one integer, so ranks compare directly.
        self.merges = {
            vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(pairs)
        }
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.final = [vocab[letters[b] + self.end] for b in range(256)]
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.letter_bytes = {c: b for b, c in letters.items()}
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge_word(self, word: bytes) -> list[int]:
        parts = [self.inner[b] for b in word]
        parts[-1] = self.final[word[-1]]
        if len(parts) > SHORT_PARTS:
            return self.merge_long(parts)
        rank = self.merges.get
        ranks = [rank(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            new = parts[i] = least & MASK
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | new, NO_RANK)
            if i < len(ranks):
                ranks[i] = rank(new << 20 | parts[i + 1], NO_RANK)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap of (rank, position); parts are linked by position."""
        n = len(parts)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank = self.merges.get
        heap = [(rank(parts[i] << 20 | parts[i + 1], NO_RANK), i) for i in range(n - 1)]
        heap = [h for h in heap if h[0] != NO_RANK]
        heapq.heapify(heap)
        while heap:
            found, i = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or rank(parts[i] << 20 | parts[j], NO_RANK) != found:
                continue
            parts[i] = found & MASK
            live[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    r = rank(parts[k] << 20 | parts[after[k]], NO_RANK)
                    if r != NO_RANK:
                        heapq.heappush(heap, (r, k))
        return [p for p, ok in zip(parts, live, strict=True) if ok]

    def encode_word(self, word: str) -> bytes:
        """Packed ids of a word in normal form; remembered, as words recur in many chunks."""
        packed = self.words.get(word)
        if packed is None:
            ids = self.merge_word(word.encode())
            packed = pack(f"<{len(ids)}I", *ids)
            if len(word) <= CACHED_LENGTH:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = packed
        return packed

    def encode_chunk(self, chunk: str) -> bytes:
        """Packed ids of a text without white space."""
        if chunk.isascii():
            return b"".join(map(self.encode_word, WORD.findall(chunk.lower())))
        if max(chunk) < PLAIN_BELOW:
            normal = unicodedata.normalize("NFC", chunk)
            # Letter by letter: a final capital sigma has no form of its own here.
            lower = "".join(map(str.lower, normal)) if "\u03a3" in normal else normal.lower()
            return b"".join(map(self.encode_word, PLAIN_WORD.findall(lower)))
        normal = self.normalizer.normalize_str(chunk)
        words = [bytes(map(self.letter_bytes.__getitem__, w)) for w, _ in self.splitter.pre_tokenize_str(normal)]
        return b"".join(self.encode_word(w.decode()) for w in words if w)

    def encode_plain(self, text: str, out: list[bytes]) -> None:
        # str.split also splits at the four ASCII separators 1C-1F, which are no white space here.
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        cache = self.cache
        for chunk in re.split(r"[^\S\x1c-\x1f]+", text) if odd else text.split():
            packed = cache.get(chunk)
            if packed is None:
                packed = self.encode_chunk(chunk)
                if len(chunk) <= CACHED_LENGTH:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[chunk] = packed
            out.append(packed)

    def encode(self, text: str) -> bytes:
        """Ids as packed little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if "<|" in text:
            for part in self.special_at.split(text):
                if part in self.special:
                    out.append(self.special[part])
                else:
                    self.encode_plain(part, out)
        else:
            self.encode_plain(text, out)
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        return " ".join(map(self.pieces.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=1)
def loaded(path: str) -> WordBpe:
    """One per Python worker: its caches live on from task to task."""
    return WordBpe(path)


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit integers), n_tokens, decoded."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["doc_id", "ids", "n_tokens", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            for part in slices(batch, 1):
                ids = [bpe.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(ids, pa.binary()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([bpe.decode(i) for i in ids], pa.string()),
                ], names=names)

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, n_tokens long, decoded string")


def decode_ids(rows: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """Adds `decoded`: the text of packed ids. Null ids decode to the empty text."""
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            texts = [bpe.decode(i or b"") for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return rows.mapInArrow(run, f"{fields}, decoded string")
