"""Mixing sources to target weights by temperature.

Source weights are token shares raised to an exponent and normalised. The
exponent is bisected: either until the weights have a target entropy, or until
the most repeated source is read at most `max_repetition` times. Weights times
the token budget give each source's tokens. A source is read as whole passes and
one partial pass, each pass in its own pseudo-random order, and every source's
stream is dealt evenly over the blocks, so each block holds the sources in the
target proportion; documents are permuted inside a block.

Without a budget the smallest one is taken that reads every source at least
once, so no document is lost: it rests on the largest share up to an exponent of
1 and on the smallest above, where a target entropy sharper than the shares reads
the largest source (most / least)^(exponent - 1) times; beyond `MOST_PASSES` a
budget must be given. Positions in a stream are prefix sums in two levels (hash ranges of about `range_rows` documents, then inside a range): a
source with a third of all rows is spread over many tasks.

Defined results: null text has no tokens; null source is a source; a source
without tokens has no share and is read once; documents without tokens are read
as often as their source, lie in a pseudo-random block, and count as one token
each in the number of blocks; a document belongs to the block in which it starts, however long
it is; repeated rows are separate documents; an empty table gives an empty
result; other columns pass through `mixed_documents` untouched.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hearsay.llm.common import join_small, row_key, stage, words_of

BLOCK_TOKENS = 65_536
RANGE_ROWS = 2_048
LEVELS, ROUNDS = 4, 8
SHARPEST = 16.0
# Passes over a source that are read without a budget that asks for them.
MOST_PASSES = 1_000


def moments(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent a: (sum of p^a, sum of p^a ln p) over all sources, in one pass."""
    cells = []
    for i, a in enumerate(exponents):
        power = F.pow("share", F.lit(a))
        cells += [F.sum(power).alias(f"z{i}"), F.sum(power * F.ln("share")).alias(f"s{i}")]
    row = sources.agg(*cells).first()
    return [(row[f"z{i}"], row[f"s{i}"]) for i in range(len(exponents))]


def bisect_exponent(sources: DataFrame, below, high: float = 1.0) -> tuple[float, float]:
    """Bracket (low, high) within [0, high] of the exponent where `below(exponent, (z, s))` turns false.

    Four bisection levels are evaluated in one pass over the sources.
    """
    low = 0.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / 2**LEVELS for i in range(2**LEVELS + 1)]
        held = [below(a, m) for a, m in zip(points, moments(sources, points), strict=True)]
        at = held.index(False) if False in held else len(points)
        if at == 0:
            return low, low
        if at == len(points):
            return high, high
        low, high = points[at - 1], points[at]
    return low, high


def source_weights(
    sources: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None,
    budget_tokens: int | None = None,
) -> tuple[DataFrame, float, float]:
    """Sources with weight and allotted tokens; the exponent; the budget.

    `sources` has source, n_docs, tokens, share. `max_repetition` takes the
    flattest weights within the limit (smallest exponent; 1 where none is);
    `target_entropy` (nats) the most proportional weights that still have it.
    """
    filled = sources.where("share > 0")
    least, most, total = filled.agg(F.min("share"), F.max("share"), F.sum("tokens")).first()
    if total is None:
        return sources.withColumns({"weight": F.lit(0.0), "allotted": F.lit(0.0)}), 1.0, 0.0

    def repetition(a: float, z: float) -> float:
        """Passes over the smallest source, at the given budget or the smallest whole one."""
        budget = budget_tokens / total if budget_tokens else most ** (1 - a) * z
        return least ** (a - 1) * budget / z

    if target_entropy is not None:
        # Entropy of weights p^a / z is ln z - a s / z; it falls as the exponent grows.
        # Above 1, weights are sharper than the shares.
        exponent = bisect_exponent(
            filled, lambda a, m: log(m[0]) - a * m[1] / m[0] >= target_entropy - 1e-12, high=SHARPEST
        )[0]
    elif max_repetition is not None:
        exponent = bisect_exponent(filled, lambda a, m: repetition(a, m[0]) > max_repetition + 1e-9)[1]
    else:
        raise ValueError("a target entropy or a repetition limit is needed")
    z = moments(filled, [exponent])[0][0]
    scarcest = most if exponent <= 1 else least
    budget = float(budget_tokens) if budget_tokens else total * scarcest ** (1 - exponent) * z
    if not budget_tokens and exponent > 1 and (most / least) ** (exponent - 1) > MOST_PASSES:
        raise ValueError(f"weights so sharp read the largest source over {MOST_PASSES} times: a budget of tokens is needed")
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent)) / z).otherwise(0.0)
    # Rounded, so that float noise and the bisected exponent's last digits neither cut the last document of a whole
    # pass nor begin another pass.
    passes = F.round(weight * budget / F.greatest("tokens", F.lit(1)), 6)
    return sources.withColumns({"weight": weight, "allotted": passes * F.col("tokens")}), exponent, budget


def token_table(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, n_tokens, __key), written once: texts are read once."""
    return stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.size(words_of(F.coalesce(F.col(text_col), F.lit("")))).cast("long").alias("n_tokens"),
        row_key(id_col, source_col, text_col).alias("__key"),
    ), "tokens")


def source_shares(rows: DataFrame) -> DataFrame:
    tokens = rows.agg(F.sum("n_tokens")).first()[0] or 0
    return stage(rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"),
        F.sum((F.col("n_tokens") == 0).cast("long")).alias("n_empty"),
    ).withColumn("share", F.col("tokens") / F.lit(float(max(tokens, 1)))), "shares")


def unit_hash(*columns: Column) -> Column:
    """A pseudo-random number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(2**53))


def passes_read() -> Column:
    """Passes over a source, the last one whole or partial."""
    passes = F.when(F.col("tokens") > 0, F.ceil(F.col("allotted") / F.col("tokens"))).otherwise(1)
    return F.greatest(passes, F.lit(1))


def streams(rows: DataFrame, weighed: DataFrame, seed: int) -> DataFrame:
    """Every pass over every source as rows, with the offset in the source's token stream."""
    with_source = join_small(rows, weighed, ["source"])
    copies = with_source.withColumn(
        "copy", F.explode(F.sequence(F.lit(0), passes_read().cast("int") - 1))
    )
    placed = copies.withColumn("u", unit_hash(F.lit(seed), "copy", "doc_id", "__key")).withColumn(
        "part", F.floor(F.col("u") * F.ceil(F.col("n_docs") / RANGE_ROWS)).cast("long")
    )
    keys = ["source", "copy", "part"]
    parts = placed.groupBy(*keys).agg(F.sum("n_tokens").alias("sum"))
    before = Window.partitionBy("source", "copy").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(parts.withColumn("base", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum"), "bases")
    inside = Window.partitionBy(*keys).orderBy("u", "doc_id", "__key", "n_tokens")
    running = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    joined = placed.join(
        bases.withColumnsRenamed({k: f"b_{k}" for k in keys}),
        F.col("source").eqNullSafe(F.col("b_source")) & (F.col("copy") == F.col("b_copy"))
        & (F.col("part") == F.col("b_part")),
    )
    offset = F.col("copy") * F.col("tokens") + F.col("base") + running
    return joined.withColumn("offset", offset)


def mix_sources(
    docs: DataFrame, max_repetition: float | None = 2.0, target_entropy: float | None = None,
    budget_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document and pass that is read: doc_id, source, n_tokens, copy, block, position.

    Also weight (of the source) and __key, the row's identity.
    """
    rows = token_table(docs, id_col, text_col, source_col)
    weighed, _, budget = source_weights(source_shares(rows), max_repetition, target_entropy, budget_tokens)
    weighed = stage(weighed, "weights")
    empty = weighed.agg(F.sum(F.col("n_empty") * passes_read())).first()[0] or 0
    blocks = max(1, ceil((budget + empty) / block_tokens))
    read = streams(rows, weighed, seed).where(
        "tokens = 0 or offset < allotted or copy < floor(round(allotted / tokens, 9))"
    )
    worded = (F.col("n_tokens") > 0) & (F.col("allotted") > 0)
    anywhere = unit_hash(F.lit(seed), F.lit("block"), "copy", "doc_id", "__key")
    share = F.when(worded, F.col("offset") / F.col("allotted")).otherwise(anywhere)
    dealt = read.withColumn("block", F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("long"))
    order = Window.partitionBy("block").orderBy(unit_hash(F.lit(-seed), "block", "copy", "doc_id", "__key"), "doc_id")
    return dealt.withColumn("position", F.row_number().over(order)).select(
        "doc_id", "source", "n_tokens", "copy", "block", "position", "weight", "__key"
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options,
) -> DataFrame:
    """The documents in mixed order, repeated as the weights ask, with all their columns."""
    plan = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    # Repeated rows share a key and are each in the plan: one copy of the row serves them all.
    plan = plan.select("__key", F.col("copy").alias("__copy"), F.col("block").alias("__block"), F.col("position").alias("__at"))
    plan = stage(plan, "plan")
    marked = docs.withColumn("__key", row_key(id_col, source_col, text_col))
    if not plan.where("__copy = 0").groupBy("__key").count().where("count > 1").isEmpty():
        marked = marked.dropDuplicates(["__key"])
    mixed = marked.join(plan, "__key")
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = mixed.repartition(int(parts), "__block").sortWithinPartitions("__block", "__at")
    return ordered.select(*docs.columns)
