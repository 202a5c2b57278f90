"""Exact dedup by a tree merge of sorted digest runs.

Every input partition turns its texts into one run: a row per distinct digest
with the winning id and the number of copies, sorted by digest. Rounds merge
`fan_in` neighbouring runs at a time until one is left. A round deals the runs by
ranges of (run, digest), sorts each range, and merges equal neighbours in that
order by a sorted aggregate; what it writes is sorted again. So a run is spread
over tasks by digest and no round gathers one in a task. At every level rows merge
only where the whole SHA-256 and the byte length are equal.

The decision goes back the way it came: from the last run to those it was merged
from, down to the rows of an input partition. A join never meets more than
`fan_in` rows of a digest, or the copies within one input partition, however many
copies of a text there are.

Defined results: null text counts as empty; empty texts are equal to each other;
a null id never wins against an id; repeated rows of one id and text count each
in group_size and share `kept`; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.llm.common import ascii_lower, stage

FAN_IN = 16
KEY = ["run", "digest", "n_bytes"]


def merge_runs(runs: DataFrame, fan_in: int) -> DataFrame:
    """One round: fan_in neighbouring runs become one, sorted by digest; fan_in 1 makes rows into runs.

    The winner is the greatest of structs, whose aggregate Spark does on sorted input.
    """
    parent = F.floor(F.col("run") / fan_in).cast("long").alias("run")
    dealt = runs.select(parent, "digest", "n_bytes", F.struct("keep_id").alias("won"), "group_size")
    merged = dealt.repartitionByRange(*KEY).groupBy(*KEY).agg(F.max("won").alias("won"), F.sum("group_size").alias("group_size"))
    return merged.select(*KEY, F.col("won.keep_id").alias("keep_id"), "group_size")


def digest_table(docs: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    """(run, doc_id, digest, n_bytes), written once; texts are read once."""
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    return stage(
        rows.select(
            F.spark_partition_id().cast("long").alias("run"),
            "doc_id",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        ),
        "digests",
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN,
    normalise=ascii_lower, largest: bool = True,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest id stays (`largest=False`: the smallest, by merging
    negated ids).
    """
    rows = digest_table(docs, id_col, text_col, normalise)
    sign: Column = F.lit(1 if largest else -1)
    runs = rows.select(
        "run", "digest", "n_bytes", (F.col("doc_id") * sign).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    levels = [stage(merge_runs(runs, 1), "run")]
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        levels.append(stage(merge_runs(levels[-1], fan_in), "run"))
        last //= fan_in
    # A unique text needs no partner: only groups of copies are carried back.
    found = levels.pop().where("group_size > 1")
    while levels:
        level = levels.pop().select(*KEY, F.floor(F.col("run") / fan_in).cast("long").alias("up"))
        above = found.select(F.col("run").alias("up"), "digest", "n_bytes", "keep_id", "group_size")
        found = level.join(above, ["up", "digest", "n_bytes"])
    groups = found.select(*KEY, (F.col("keep_id") * sign).alias("keep_id"), "group_size")
    both = rows.join(groups, KEY, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return both.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns. Of repeated rows of one id and text, one stays."""
    found = stage(exact_dedup(docs, id_col, text_col), "decisions").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept"
    )
    tagged = docs.withColumn("__own", F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))

    def mark(rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
        match = rows[id_col].eqNullSafe(marks["__id"]) & (rows["__own"] == marks["__sha"])
        return rows.join(marks, match, how)

    rest = mark(tagged, found.where(~F.col("kept")).select("__id", "__sha").distinct(), "left_anti")
    repeats = found.where("kept").groupBy("__id", "__sha").count().where("count > 1")
    if not repeats.isEmpty():
        once = mark(rest, repeats, "left_semi").dropDuplicates([id_col, "__own"])
        rest = mark(rest, repeats, "left_anti").unionByName(once)
    return rest.select(*docs.columns)
