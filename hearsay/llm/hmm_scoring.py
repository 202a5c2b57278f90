"""LM scoring with a hidden Markov model over words.

Word counts cover all training documents, and every training word has emissions
of its own in every state. A text is its words and one end. Baum-Welch trains the
latent states: tasks add up the expected counts of (state, word), which are summed
by word in a table on Spark that grows with the vocabulary. The scaled forward and
backward recursions run over whole texts, however long.

Emissions are expected counts and half a count, which each word gets dealt over
the states by their tokens: a word that training has not seen is about as likely
as under the smoothed unigram of `base_score`.

Texts are coded in chunks of about `CHUNK` bytes, with the chunk's distinct words.
Counts and emissions of the `frequent` most frequent words travel to the tasks (a
bounded table). Expected counts of a word that lies in one chunk alone stay beside
the chunk. Only words that chunks share move: each chunk's sums of them are dealt
by ranges of their hashes, added up, and brought back to the chunks that hold them. Chunks and what
belongs to them are bucketed by chunk, so they meet without moving. Nothing that
grows with the vocabulary is broadcast or sent to the driver, and no hot word is
left to be dealt. Words are identified by 64-bit hashes.

Defined results: a null or empty text is one end; a null id counts as training;
without training documents counts are zero and the model is uniform; repeated
rows are scored alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.llm.common import discard, let_go, stage, stage_by
from hearsay.llm.words import hashed_words, mix, slices

STATES, FREQUENT, PASSES = 8, 150_000, 6
# Bytes of shared words' sums that one task adds up.
PART = 32 << 20
# Bytes of text in a chunk; the fewest chunks in a bucket while tasks are enough, and the most; tokens whose recursions
# run in step, and of which all steps are kept; rows that are added up at once.
CHUNK, FEW, MANY, BLOCK, WINDOW, SPAN = 6 << 20, 6, 16, 3 << 17, 3 << 18, 1 << 12


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of a one-column frame; added up per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            size = 0
            for part in [*slices(batch, 0), None]:
                if part is not None:
                    held.append(hashed_words(part.column(0))[0])
                    size += len(held[-1])
                if size and (part is None or size > 8_000_000):
                    word, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"]
                    )
                    held, size = [], 0

    found = texts.mapInArrow(run, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What tasks need to know about words."""

    words: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray  # their counts, then the number of ends
    train_tokens: int
    distinct: int

    @property
    def end(self) -> int:
        return len(self.words)

    @property
    def base(self) -> float:
        return self.train_tokens + 0.5 * (self.distinct + 1)


def vocabulary(counts: DataFrame, ends: int, frequent: int) -> Vocabulary:
    """`counts` are the words of the training documents, `ends` their number."""
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    word, n = (top.column(c).to_numpy() for c in ("word", "n"))
    word = word.view(np.uint64)
    order = np.argsort(word)
    return Vocabulary(word[order], np.append(n[order], ends), (total or 0) + ends, distinct + (ends > 0))


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Chunks of training or of held-out texts.

    `symbols` point into the chunk's frequent words (with the end), then its other `words`, of which `counts` are
    in the order of their hashes; in a held-out chunk these are zeros.
    """

    def code(part: pa.Table, held_out: bool) -> pa.RecordBatch:
        h, first = hashed_words(part.column(3).combine_chunks())
        words, place, n = np.unique(h, return_inverse=True, return_counts=True)
        at = np.minimum(np.searchsorted(vocab.words, words), max(vocab.end - 1, 0))
        hit = vocab.words[at] == words if vocab.end else np.zeros(len(words), bool)
        # The frequent words, the end, the others.
        symbol = np.where(hit, np.cumsum(hit) - 1, hit.sum() + np.cumsum(~hit))
        symbols = np.insert(symbol[place], first[1:], hit.sum())
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        return pa.RecordBatch.from_arrays(
            [part.column(0).chunk(0)[:1], pa.array([held_out]), one(part.column(1).combine_chunks()), one(pa.array(np.diff(first) + 1)),
             pa.array([dense(symbols)], pa.binary()), one(pa.array(np.append(at[hit], vocab.end).astype(np.int32))),
             one(pa.array(words[~hit].view(np.int64))), one(pa.array(n[~hit] * (not held_out)))],
            names=["chunk", "held_out", "ids", "n", "symbols", "frequent", "words", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        size = {False: 0, True: 0}
        for batch in batches:
            for part in slices(batch, 3):
                held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                for kind in (False, True):
                    if (held == kind).any():
                        own = part.filter(pa.array(held == kind))
                        waiting[kind].append(own)
                        size[kind] += own.column(3).nbytes
                        if size[kind] >= CHUNK:
                            yield code(pa.Table.from_batches(waiting[kind]), kind)
                            waiting[kind], size[kind] = [], 0
        for kind, parts in waiting.items():
            if parts:
                yield code(pa.Table.from_batches(parts), kind)

    id_type = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(
        run,
        f"chunk long, held_out boolean, ids array<{id_type}>, n array<long>, symbols binary, "
        "frequent array<int>, words array<long>, counts array<long>",
    )


def dense(symbols: np.ndarray) -> bytes:
    """Symbols as compressed byte planes: the upper ones hold next to nothing."""
    planes = np.ascontiguousarray(symbols.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def undense(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * size, "zstd"), np.uint8).reshape(4, size)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0]


@dataclass
class Hmm:
    """Start of a text, expected tokens, transitions, and emissions (states x words; in training the frequent ones)."""

    start: np.ndarray
    tokens: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def emissions(expected: np.ndarray, tokens: np.ndarray, distinct: int) -> np.ndarray:
    """Probabilities (words x states) from the words' expected counts and the states' tokens."""
    half = 0.5 * (tokens + 0.1) / (tokens + 0.1).sum()
    return (expected + half) / (tokens + half * (distinct + 1))


def first_shares(words: np.ndarray, states: int) -> np.ndarray:
    """How a word's count is dealt over the states at first: at random, by its hash."""
    seeds = np.arange(1, states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    noise = np.exp(12**0.5 * ((mix(words[:, None] ^ seeds) >> np.uint64(11)) / 2.0**53 - 0.5))
    return noise / noise.sum(axis=1, keepdims=True)


def through_words(
    rows: DataFrame, kind: np.dtype, records: Callable[[pa.RecordBatch, int], np.ndarray], back: Callable[[np.ndarray, np.ndarray], np.ndarray],
    parts: int, buckets: int,
) -> DataFrame:
    """(chunk, data): for each chunk's records what `back` makes of all records of their words.

    Words are dealt over `parts` equal ranges of their hashes: a chunk sends one packed
    row to each and gets one back, so rows are few however many words there are.
    `records` gives a chunk's records, of the type `kind`, with their `word`, in the order of the hashes;
    `back(records, place)` an entry for each, `place` being equal for equal words.
    """
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)

    def packed(number: list[int], part: list[int], data: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=["chunk", "part", "data"]
        )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = records(batch, i)
                cuts = np.split(found, np.searchsorted(found["word"].view(np.uint64), edges))
                sent = [k for k, c in enumerate(cuts) if len(c)]
                if sent:
                    yield packed([batch.column(0)[i].as_py()] * len(sent), sent, [cuts[k].tobytes() for k in sent])

    def groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
        """Neighbouring rows (chunk, part, data) that are equal in one column."""
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[key] != held[0][key]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches, 1):
            found = [np.frombuffer(data, kind) for _, _, data in held]
            rows = np.concatenate(found)
            made = back(rows, np.unique(rows["word"], return_inverse=True)[1])
            answers = np.split(made, np.cumsum([len(f) for f in found])[:-1])
            yield packed([h[0] for h in held], [h[1] for h in held], [x.tobytes() for x in answers])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[0][0]], pa.int64()), pa.array([b"".join(h[2] for h in held)], pa.binary())], names=["chunk", "data"]
            )

    schema = "chunk long, part int, data binary"
    dealt = rows.mapInArrow(spread, schema).repartition(parts, "part").sortWithinPartitions("part").mapInArrow(answer, schema)
    return dealt.repartition(buckets, "chunk").sortWithinPartitions("chunk", "part").mapInArrow(joined, "chunk long, data binary")


FACTS = np.dtype([("n", "<i8"), ("shared", "?")])


def chunk_table(coded: DataFrame, states: int) -> tuple[DataFrame, int, int]:
    """Chunks with `facts` of their words: training counts, and whether another chunk has the word too.

    Also the number of buckets, and of the parts that words are dealt over.
    """
    kind = np.dtype([("word", "<i8"), ("n", "<i8")])

    def records(batch: pa.RecordBatch, i: int) -> np.ndarray:
        words, n = (batch.column(c)[i].values.to_numpy() for c in (1, 2))
        found = np.zeros(len(words), kind)
        found["word"], found["n"] = words, n
        return found

    def back(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        made = np.zeros(len(rows), FACTS)
        # Counts stay exact: they are far below 2^53.
        made["n"] = np.bincount(place, rows["n"])[place]
        made["shared"] = (np.bincount(place) > 1)[place]
        return made

    n, pairs = coded.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    parts = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(parts, ceil(n / FEW)), ceil(n / MANY))
    parts = max(parts, ceil((pairs or 0) * record_type(states).itemsize / PART))
    facts = through_words(coded.select("chunk", "words", "counts"), kind, records, back, parts, buckets)
    # Chunks move once, to the buckets in which they are joined and written.
    whole = coded.drop("counts").repartition(buckets, "chunk").join(facts.withColumnRenamed("data", "facts"), "chunk", "left")
    return stage_by(whole, "chunks", "chunk", buckets, "zstd"), buckets, parts


def first_model(vocab: Vocabulary, tokens: np.ndarray, states: int) -> Hmm:
    """Sticky states, and the frequent words' emissions from counts dealt at random."""
    even = np.full(states, 1.0 / states)
    shares = np.vstack([first_shares(vocab.words, states), even])
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Hmm(even, tokens, move, emissions(vocab.counts[:, None] * shares, tokens, vocab.distinct).T)


def first_tokens(counts: DataFrame, ends: int, states: int) -> np.ndarray:
    """Tokens of each state when all counts are dealt at random."""
    names = [f"g{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states)
        for batch in batches:
            word, n = (batch.column(i).to_numpy() for i in range(2))
            total += n @ first_shares(word.view(np.uint64), states)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=names)

    sums = counts.mapInArrow(run, ", ".join(f"{g} double" for g in names)).agg(*[F.sum(g) for g in names]).first()
    return np.array([x or 0.0 for x in sums]) + ends / states


def blocks(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Places of texts with about BLOCK tokens, the longest first: texts of much the same length run in step, so few steps have few rows."""
    size = np.array([len(t) for t in texts])
    order = np.argsort(-size, kind="stable")
    ends = np.cumsum(size[order])
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
        yield order[a:b]
        a = b


def in_step(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Order by falling length, so that those still running are always the first rows; symbols, step by step; rows running at each step."""
    n = np.array([len(t) for t in texts])
    order = np.argsort(-n, kind="stable")
    length = n[order]
    live = np.searchsorted(-length, -np.arange(int(length[0])), "left")
    slot = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    slot = (np.cumsum(live) - live)[slot]
    slot += np.repeat(np.arange(len(n)), length)
    seen = np.empty(len(slot), np.int64)
    seen[slot] = np.concatenate([texts[i] for i in order])
    return order, seen, live


def seldom(least: float, digits: int) -> int:
    """Steps to go without scaling, so that all and one more leave 10^-digits, when each leaves `least` at least."""
    return max(1, int(digits / max(-np.log10(least), 0.1)) - 1) if least > 0 else 1


def expected_counts(texts: list[np.ndarray], hmm: Hmm, steps: int | None = None) -> tuple[np.ndarray, ...]:
    """Baum-Welch sums over whole texts: of starts, transitions and emissions (words x states).

    Texts run in step, a block at a time. What a step leaves is kept for a window of about
    `WINDOW` tokens (or of `steps` steps); with more than one, the forward recursion starts anew
    from its state at a window's border, and the backward recursion is carried over it.
    Only the recursions go step by step, the sums `SPAN` rows at once. Emissions count
    relative to the word's likeliest state, so a step leaves at least the least transition,
    and recursions are scaled as seldom as 32-bit floats allow; sums are in 64 bits.
    """
    states, size = hmm.emit.shape
    table, move, begin = (np.ascontiguousarray(v, np.float32) for v in (hmm.emit.T / hmm.emit.max(axis=0)[:, None], hmm.move, hmm.start))
    start, pairs, emit = np.zeros(states), np.zeros((states, states)), np.zeros((size, states))
    for block in blocks(texts):
        add_counts([texts[i] for i in block], table, move, begin, steps, (start, pairs, emit))
    return start, pairs * hmm.move, emit


def add_counts(
    texts: list[np.ndarray], table: np.ndarray, move: np.ndarray, begin: np.ndarray, steps: int | None, sums: tuple[np.ndarray, ...]
) -> None:
    """Add a block's starts, transitions (to be multiplied by `move`) and emissions to the sums."""
    start, pairs, emit = sums
    states, size = len(begin), len(table)
    back, ones = np.ascontiguousarray(move.T), np.ones((states, 1), np.float32)
    scaled = seldom(float(move.min()), 28)
    _, symbols, live = in_step(texts)
    place, last = np.concatenate([[0], np.cumsum(live)]), len(live)
    cuts = range(0, last, steps) if steps else np.unique(np.searchsorted(place, np.arange(0, place[-1], WINDOW), "left")).tolist()
    windows = list(zip(cuts, [*cuts[1:], last], strict=True))

    def slots(a: int, b: int) -> list[tuple[int, int, int]]:
        edges = (place[a : b + 1] - place[a]).tolist()
        return list(zip(range(a, b), edges[:-1], edges[1:], strict=True))

    def forward(a: int, b: int, now: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Scaled emissions and forward probabilities of steps a to b, one step after the other."""
        shown = np.take(table, symbols[place[a] : place[b]], axis=0)
        alpha = np.empty_like(shown)
        for t, i, j in slots(a, b):
            out, emitted = alpha[i:j], shown[i:j]
            if now is None:
                out[:] = begin
            else:
                np.dot(now[: j - i], move, out)
            np.multiply(out, emitted, out)
            if t % scaled == 0:
                scale = np.dot(out, ones)
                out /= scale
                emitted /= scale
            now = out
        return shown, alpha

    borders: list[np.ndarray | None] = [None]
    for a, b in windows[:-1]:
        borders.append(forward(a, b, borders[-1])[1][place[b - 1] - place[a] :].copy())
    ahead, later = np.zeros((0, states), np.float32), np.empty((len(texts), states), np.float32)
    fewer = live - np.append(live[1:], 0)
    for (a, b), now in zip(reversed(windows), reversed(borders), strict=True):
        shown, alpha = forward(a, b, now)
        # A text's last rows in their steps: the probability of the whole text is left there.
        ends = np.flatnonzero(fewer[a:b]) + a
        ends = np.concatenate([np.arange(place[t + 1] - fewer[t], place[t + 1]) for t in ends] or [ends]) - place[a]
        shown[ends] /= np.dot(alpha[ends], ones)
        edge = int(place[b - 1] - place[a])
        pairs += alpha[edge : edge + len(ahead)].T @ ahead
        for _, i, j in reversed(slots(a, b)):
            k, emitted = len(ahead), shown[i:j]
            if k:
                met = emitted[:k]
                np.multiply(met, np.dot(ahead, back, later[:k]), met)
            ahead = emitted
        # The row before lies as far back as its step is wide. From the last rows on, as probabilities take the place of `alpha`.
        ahead, seen, width = ahead.copy(), symbols[place[a] : place[b]], int(live[a])
        step = np.repeat(live[a : b - 1].astype(np.int32), live[a + 1 : b])
        for i in reversed(range(0, len(seen), SPAN)):
            j, k = min(i + SPAN, len(seen)), max(i, width)
            if k < j:
                pairs += np.take(alpha, np.arange(k, j) - step[k - width : j - width], axis=0).T @ shown[k:j]
            own = alpha[i:j]
            own *= shown[i:j]
            own /= np.take(table, seen[i:j], axis=0)
            own /= np.dot(own, ones)
        for j in range(states):
            emit[:, j] += np.bincount(seen, alpha[:, j], size)
    start += alpha[: live[0]].sum(axis=0, dtype=float)


@dataclass
class Chunk:
    """A chunk's texts, and counts and emissions of its words: the frequent ones, then the others."""

    number: int
    ids: pa.Array
    texts: list[np.ndarray]
    frequent: np.ndarray
    words: np.ndarray
    shared: np.ndarray
    counts: np.ndarray
    table: np.ndarray


def shortened(values: np.ndarray) -> np.ndarray:
    """Floats in three bytes each: 15 bits of fraction and the whole range of a 32-bit float."""
    bits = np.ascontiguousarray(values, "<f4").view("<u4") + np.uint32(0x80)
    return bits.view(np.uint8).reshape(*values.shape, 4)[..., 1:].reshape(len(values), 3 * values.shape[1])


def lengthened(data: np.ndarray, states: int) -> np.ndarray:
    out = np.zeros((data.size // (3 * states), states, 4), np.uint8)
    out[..., 1:] = data.reshape(-1, states, 3)
    return out.view("<f4")[..., 0]


def opened(batch: pa.RecordBatch, i: int, hmm: Hmm, vocab: Vocabulary, first: bool, kind: type) -> Chunk:
    """A chunk of a batch, emissions as floats of a kind. At first, words have the counts dealt at random, later those that the last pass left."""
    states = len(hmm.start)
    cell = lambda c: batch.column(c)[i]
    values = lambda c, t: (cell(c).values if cell(c).is_valid else pa.array([], t)).to_numpy(zero_copy_only=False)
    n, frequent, words = (values(c, pa.int64()) for c in ("n", "frequent", "words"))
    facts = np.frombuffer(cell("facts").as_py() or b"", FACTS)
    count, shared = facts["n"], facts["shared"]
    symbols = undense(cell("symbols").as_py(), int(n.sum()))
    if first:
        expected = count[:, None] * first_shares(words.view(np.uint64), states)
    else:
        expected = np.zeros((len(words), states))
        own, met = (lengthened(np.frombuffer(cell(c).as_py() or b"", np.uint8), states) for c in ("local", "met"))
        if len(own):
            expected[~shared] = own
        if len(met):
            expected[shared] = met
    table = np.empty((len(frequent) + len(words), states), kind)
    table[: len(frequent)] = hmm.emit.T[frequent]
    table[len(frequent) :] = emissions(expected, hmm.tokens, vocab.distinct)
    return Chunk(
        cell("chunk").as_py(), cell("ids").values, np.split(symbols, np.cumsum(n)[:-1]), frequent, words, shared,
        np.concatenate([vocab.counts[frequent], count]), table,
    )


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside the block hand rows to Python a few at a time: large ones, of which neither side should hold a bucket."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def expectation(chunks: DataFrame, hmm: Hmm, vocab: Vocabulary, first: bool, buckets: int) -> tuple[DataFrame, Hmm]:
    """One pass over all training texts: each chunk's sums of its words, and the model of the frequent ones.

    The sums are (chunk, local, sums): expected counts of the words that no other chunk
    has, and records (word, expected counts) of those that are shared.
    """
    states, end = len(hmm.start), vocab.end
    # Ranges of the sums are as many as partitions, which grow with the corpus, so no range grows with it.
    pieces = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = ceil((end + 3 + states) / pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Frequent words, the end, starts, transitions, tokens of each state.
        total = np.zeros((end + 3 + states, states))

        def sums_of(c: Chunk) -> pa.RecordBatch:
            start, pairs, emit = expected_counts(c.texts, Hmm(hmm.start, hmm.tokens, hmm.move, c.table.T))
            total[end + 1] += start
            total[end + 2 : -1] += pairs
            total[c.frequent] += emit[: len(c.frequent)]
            total[-1] += emit.sum(axis=0)
            own = shortened(emit[len(c.frequent) :])
            sums = np.zeros(int(c.shared.sum()), record_type(states))
            sums["word"], sums["v"] = c.words[c.shared], own[c.shared]
            return batch_of(1, chunk=[c.number], local=[own[~c.shared].tobytes()], sums=[sums.tobytes()])

        # One chunk is open at a time: what it needs is gone when the next one comes.
        for batch in batches:
            for i in range(batch.num_rows):
                yield sums_of(opened(batch, i, hmm, vocab, first, np.float32))
        for part, at in enumerate(range(0, len(total), piece)):
            rows = total[at : at + piece]
            found = np.zeros(int(rows.any(axis=1).sum()), kind)
            found["place"] = np.flatnonzero(rows.any(axis=1))
            found["v"] = rows[found["place"]]
            if len(found):
                yield batch_of(1, part=[part], data=[found.tobytes()])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.frombuffer(data.as_buffer(), kind)
                totals.setdefault(part, np.zeros((piece, states)))[found["place"]] += found["v"]
        for part, rows in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([rows.tobytes()], pa.binary())], names=["part", "data"])

    kind = np.dtype([("place", "<i4"), ("v", "<f4", (states,))])
    types = {"chunk": pa.int64(), "local": pa.binary(), "sums": pa.binary(), "part": pa.int32(), "data": pa.binary()}

    def batch_of(size: int, **columns) -> pa.RecordBatch:
        cells = [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()]
        return pa.RecordBatch.from_arrays(cells, names=list(types))

    schema = "chunk long, local binary, sums binary, part int, data binary"
    with batches_of(chunks.sparkSession, 1):
        found = stage_by(chunks.mapInArrow(run, schema), "sums", "chunk", buckets, "none")
    # One entry per frequent word and for the rest of the model, at any size of the corpus; tasks send them by ranges.
    dealt = found.where("chunk is null").select("part", "data").repartition(pieces, "part")
    with batches_of(chunks.sparkSession, 64):
        sums = dealt.mapInArrow(added, "part int, data binary").toArrow()
    total = np.zeros((pieces * piece, states))
    for part, data in zip(sums.column(0).to_pylist(), sums.column(1).to_pylist(), strict=True):
        total[part * piece : (part + 1) * piece] = np.frombuffer(data).reshape(piece, states)
    total = total[: end + 3 + states]
    let_go(found)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    emit = emissions(total[: end + 1], total[-1], vocab.distinct).T
    return found, Hmm(share(total[end + 1] + 0.1), total[-1], share(total[end + 2 : -1] + 0.1), emit)


def record_type(states: int) -> np.dtype:
    return np.dtype([("word", "<i8"), ("v", "u1", (3 * states,))])


def met_again(own: DataFrame, held_out: DataFrame | None, states: int, parts: int, buckets: int) -> DataFrame:
    """(chunk, met): for each chunk the sums over all chunks of the words it shares, in its words' order.

    `held_out` are chunks that have no sums of their own but ask for those of others.
    """
    kind = record_type(states)

    def records(batch: pa.RecordBatch, i: int) -> np.ndarray:
        sums, facts = batch.column(1)[i].as_py(), batch.column(3)[i].as_py()
        if sums is not None or facts is None:
            return np.frombuffer(sums or b"", kind)
        words = batch.column(2)[i].values.to_numpy()[np.frombuffer(facts, FACTS)["shared"]]
        found = np.zeros(len(words), kind)
        found["word"] = words
        return found

    def back(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        values = lengthened(rows["v"], states)
        return shortened(np.stack([np.bincount(place, values[:, k]) for k in range(states)], axis=1))[place]

    none = lambda kind: F.lit(None).cast(kind)
    rows = own.where("chunk is not null").select("chunk", "sums", none("array<long>").alias("words"), none("binary").alias("facts"))
    if held_out is not None:
        rows = rows.union(held_out.select("chunk", none("binary"), "words", "facts"))
    found = through_words(rows, kind, records, back, parts, buckets)
    met = stage_by(found.withColumnRenamed("data", "met"), "met", "chunk", buckets, "none")
    let_go(met)
    return met


def log_likelihoods(texts: list[np.ndarray], hmm: Hmm) -> np.ndarray:
    """log10 of each whole text's probability: the forward recursion, all texts in step, scaled as seldom as 64-bit floats allow."""
    order, symbols, live = in_step(texts)
    table, move, ones = np.ascontiguousarray(hmm.emit.T), np.ascontiguousarray(hmm.move), np.ones((len(hmm.start), 1))
    scaled = seldom(float(hmm.move.min() * table.max(axis=1).min()), 250)
    total, left = np.zeros(len(texts)), np.empty((len(texts), len(hmm.start)))
    now = np.broadcast_to(hmm.start, left.shape)
    ends = np.cumsum(live).tolist()
    for t, (i, j) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        k = j - i
        left[k : len(now)] = now[k:]
        now = now[:k] if t == 0 else np.dot(now[:k], move)
        now = now * np.take(table, symbols[i:j], axis=0)
        if (t + 1) % scaled == 0:
            scale = np.dot(now, ones)
            now /= scale
            total[:k] += np.log10(scale[:, 0])
    left[: len(now)] = now
    out = np.empty(len(texts))
    out[order] = total + np.log10(left.sum(axis=1))
    return out


def scored(chunks: DataFrame, hmm: Hmm, vocab: Vocabulary, first: bool) -> DataFrame:
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def scores(c: Chunk) -> Iterator[pa.RecordBatch]:
        model = Hmm(hmm.start, hmm.tokens, hmm.move, c.table.T)
        for block in blocks(c.texts):
            texts = [c.texts[i] for i in block]
            n = np.array([len(t) for t in texts])
            begin, flat = np.cumsum(n) - n, np.concatenate(texts)
            count = c.counts[flat]
            base = np.add.reduceat(np.log10(count + 0.5), begin) - n * np.log10(vocab.base)
            known = np.add.reduceat((count > 0).astype(np.int64), begin)
            yield pa.RecordBatch.from_arrays(
                [c.ids.take(pa.array(block)), pa.array(n), pa.array(known), pa.array(base), pa.array(log_likelihoods(texts, model))],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from scores(opened(batch, i, hmm, vocab, first, float))

    id_type = dict(chunks.dtypes)["ids"][len("array<") : -1]
    return chunks.mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")


def held_out(doc_id: str) -> Column:
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 1, F.lit(False))


def hmm_scoring(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, frequent: int = FREQUENT,
    passes: int = PASSES,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ends = rows.where("not held_out").count()
    counts = stage(word_counts(rows.where("not held_out").select("text")), "word-counts")
    let_go(counts)
    vocab = vocabulary(counts, ends, frequent)
    coded = stage(encoded(rows, vocab), "coded")
    chunks, buckets, parts = chunk_table(coded, states)
    hmm = first_model(vocab, first_tokens(counts, ends, states), states)
    discard(counts, coded)

    training, asking = chunks.where("not held_out"), chunks.where("held_out")
    before: tuple[DataFrame, ...] = ()

    def with_sums(frame: DataFrame) -> DataFrame:
        if not before:
            return frame
        own, met = before
        own = own.where("chunk is not null").select("chunk", "local")
        return frame.join(own, "chunk", "left").join(met, "chunk", "left")

    for left in reversed(range(passes if ends else 0)):
        own, hmm = expectation(with_sums(training), hmm, vocab, not before, buckets)
        if before:
            discard(*before)
        before = own, met_again(own, None if left else asking, states, parts, buckets)
    found = scored(with_sums(chunks), hmm, vocab, not before)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known",
        F.lit(vocab.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
