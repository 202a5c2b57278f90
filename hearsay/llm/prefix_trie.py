"""Prefix trie of conversations by whole-sequence collapse.

A turn counts by a 128-bit digest of role and text. The key of a prefix is the
running XOR of its turns' digests, each mixed with its place, in two 64-bit
halves; with the depth it names a node.

1. Collapse: conversations equal in whole become one weighted sequence, named by
   its smallest id. The ids that end in it are listed in sorted streams: tasks
   join ids to pieces of up to `PIECE`, and only the pieces of a sequence meet, in
   order, in the task that hashes them.
2. Leaves: sequences that are a proper prefix of another drop out by an anti join.
3. Weighted prefixes of the distinct sequences are aggregated to nodes. A node's
   own saving reaches its ancestors through one sequence: the owner (smallest
   member) of a node owns all deeper nodes of its sequence, so a suffix sum along
   each sequence, added up by prefix, is the sum over the subtree.

Copies cost nothing after step 1. Positions, prefixes and suffix sums use running
aggregates that cut a long conversation at partition borders (`ordered`).

Defined results: null role or text counts as empty; turns without a conversation
id are not part of any conversation; turns of equal number follow each other by
role, then digest; repeated rows are turns of their own; a conversation whose
rebuilt sequence is empty ends at the root; an empty table has no node; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.llm.common import stage
from hearsay.llm.ordered import running

# Ids joined to one piece of an end list; children from which a node's name is broadcast to them, and
# the share of all nodes that such a node must have, so that there are at most HOT_NODES of them.
PIECE, HOT, HOT_NODES = 1_000, 1_000, 50_000
NODE = ["depth", "k1", "k2"]


def numbered_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, pos (from 0, by turn), mark (16-byte digest of role and text), n_chars of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    mark = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.substring(mark, 1, 32)).alias("mark"), F.length(text).cast("long").alias("n_chars"),
        F.lit(1).cast("long").alias("one"),
    )
    found = running(turns, "conv_id", ["turn", "role", "mark"], {"pos": ("sum", "one")}, "turns")
    return found.select("conv_id", (F.col("pos") - 1).alias("pos"), "mark", "n_chars")


def rebuilt(
    conversations: DataFrame, block: int = 100, heads: int = 6, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, mark, n_chars) with shared beginnings, and the conversations (conv_id).

    The first h turns of conversation c come from conversation c - c % block, h being
    crc32(c) % heads; its own turns after its first h follow.
    """
    turns = stage(numbered_turns(conversations, id_col, turn_col, role_col, text_col), "numbered")
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    convs = turns.where("pos = 0").select(
        "conv_id", (crc % heads).alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base")
    )
    first = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < heads)).select(
        F.col("conv_id").alias("base"), "pos", "mark", "n_chars"
    )
    sizes = first.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    convs = stage(convs.join(sizes, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")
    ), "conversations")
    shared = convs.where("taken > 0").join(first, "base").where("pos < taken").select("conv_id", "pos", "mark", "n_chars")
    own = turns.join(convs, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "mark", "n_chars"
    )
    return shared.unionByName(own), convs.select("conv_id")


def end_digests(ends: DataFrame) -> DataFrame:
    """NODE and ends_sha256: of the comma-joined ids that end in each node, ascending."""
    id_type = dict(ends.dtypes)["conv_id"]
    keys = "depth long, k1 long, k2 long"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for batch in batches:
            for *now, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (now != key or len(held) == PIECE):
                    out.append((*key, held[0], ",".join(map(str, held))))
                    held = []
                key = now
                held.append(conv)
            yield table(out)
            out = []
        if held:
            yield table([(*key, held[0], ",".join(map(str, held)))])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in rows], pa.string())], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                state.update(ids.encode())
            yield batch_of(out)
            out = []
        if key is not None:
            yield batch_of([(*key, state.hexdigest())])

    types = [pa.int64(), pa.int64(), pa.int64(), _arrow_type(ends), pa.string()]
    dealt = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    found = dealt.mapInArrow(pieces, f"{keys}, first {id_type}, ids string")
    return found.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, f"{keys}, ends_sha256 string")


def _arrow_type(ends: DataFrame) -> pa.DataType:
    return ends.select("conv_id").limit(0).toArrow().schema.field(0).type


def with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with parent_conv_id. Parents of many children are few, whatever the data: they are broadcast."""
    many = max(HOT, nodes.count() // HOT_NODES)
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    up = ["depth", "p1", "p2"]
    hot, cold = (parents.where(c).drop("n_children") for c in (f"n_children > {many}", f"n_children <= {many}"))
    hot = F.broadcast(hot)
    return nodes.join(hot, up).unionByName(nodes.join(hot, up, "left_anti").join(cold, up, "left"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    zero = F.lit(0).cast("long")
    marked = turns.select(
        "conv_id", "n_chars", (F.col("pos") + 1).cast("long").alias("depth"),
        *[F.xxhash64(F.lit(i), "mark", "pos").alias(f"x{i}") for i in (1, 2)],
    )
    keyed = stage(running(marked, "conv_id", ["depth"], {"k1": ("bit_xor", "x1"), "k2": ("bit_xor", "x2")}, "marked"), "keyed")

    # Collapse: one row per conversation, then per distinct sequence.
    one = F.lit(1).cast("long")
    ends = stage(keyed.select("conv_id", one.alias("one"), "x1", "x2").union(
        convs.select("conv_id", zero, zero, zero)
    ).groupBy("conv_id").agg(F.sum("one").alias("depth"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2")), "ends")
    sequences = stage(ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(one).alias("n")), "sequences")
    root = sequences.select(
        "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"),
        zero.alias("n_chars"), "n", F.col("depth").alias("whole"),
    )
    prefixes = keyed.join(sequences.select("conv_id", "n", F.col("depth").alias("whole")), "conv_id").select(
        "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "n_chars", "n", "whole",
    )
    prefixes = stage(root.unionByName(prefixes), "prefixes")

    # Leaves: sequences that no longer one begins with.
    proper = prefixes.where("depth < whole").select(*NODE).distinct()
    leaves = sequences.join(proper, NODE, "left_anti").select("conv_id", one.alias("leaf"))

    nodes = prefixes.join(leaves, "conv_id", "left").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("n_chars").alias("n_chars"),
    )
    nodes = stage(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(one).alias("n_children")
    )
    own = nodes.where("n_convs > 1").select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saving"))
    # Sequences that own no saving add nothing to any node.
    along = prefixes.select("conv_id", *NODE).join(own.select("conv_id").distinct(), "conv_id", "left_semi").join(
        own, ["conv_id", "depth"], "left"
    ).select("conv_id", *NODE, F.coalesce("saving", zero).alias("saving"), (-F.col("depth")).alias("back"))
    below = running(along, "conv_id", ["back"], {"below": ("sum", "saving")}, "savings")
    saved = below.groupBy(*NODE).agg(F.sum("below").alias("saved_tokens"))

    whole = nodes.join(children, NODE, "left").join(saved, NODE, "left").join(end_digests(ends), NODE, "left")
    whole = stage(whole.fillna(0, ["n_children", "saved_tokens"]), "trie")
    return with_parents(whole).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
