"""N-gram Jaccard join: components of texts whose shingle sets are alike.

A grouped prefix join. Shingles have a total order, common ones last (levels
from a fixed-size counting sketch over all texts, then hash). Two sets that are
alike share a shingle among the first `n - ceil(t n) + 1` of each.

1. Equal sets become one unit. Units with the same prefix and size become one
   group, which enters the posting lists once.
2. Every group meets two members of each of its posting lists (picked by hash);
   group pairs are filtered by size and by a parity bitmap, whose differing bits
   never outnumber the differing shingles, and the closest partner is verified.
   Members of a group are verified against its first unit. Links give classes.
3. Posting lists that still hold more than one class are expanded to units, and
   all pairs of different classes that pass the size, place and bitmap filters
   are counted: pairs that share enough of their prefixes are verified on their whole
   sets. So no link between classes is lost, and lists that lie within one class
   cost nothing more.

No list, group or component is gathered in one place. Sets are made of 64-bit
shingle hashes.

Defined results: a text with fewer words than a shingle is one shingle; null or
empty text, or white space, has no shingle, is linked with nothing and is its
own component; rows without an id take part as nodes of their own, so chains run
through them, but a component is named by an id where it has one (else null), and
of a component without any id `one_per_component` keeps one row; rows that share
an id are one node; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.llm.common import discard, stage
from hearsay.llm.words import hashed_words, mix, slices

BUCKET_BITS = 20
MAP_BITS = 768
MEETINGS = 2
MAPS = [f"b{i}" for i in range(MAP_BITS // 64)]
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text, the sorted distinct shingle hashes."""
    words, first = hashed_words(texts)
    whole = np.zeros(0, np.uint64)
    if len(words) >= size:
        whole = np.zeros(len(words) - size + 1, np.uint64)
        for j in range(size):
            whole = whole * _STEP + words[j : len(words) - size + 1 + j]
        whole = mix(whole + np.uint64(size))
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for w in words[a:b]:
                short = short * _STEP + w
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def common_levels(texts: DataFrame, size: int) -> np.ndarray:
    """A level (0: not common) for each of 2^20 hash buckets, from all texts.

    Each task counts its sets into the buckets and reports by how much a bucket
    stands out from chance; these are added up. The result has a fixed size.
    """
    buckets = 1 << BUCKET_BITS
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                sets = shingle_sets(part.column(0), size)
                found = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                total += np.bincount((found >> shift).astype(np.int64), minlength=buckets)
        mean = total.sum() / buckets
        excess = total - int(mean + 3 * mean**0.5 + 2)
        at = np.flatnonzero(excess > 0)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(excess[at])], names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(buckets, np.uint64)
    n = sums.column("n").to_numpy()
    levels[sums.column("bucket").to_numpy()] = np.minimum(15, 1 + np.log2(np.maximum(n, 1)) // 2).astype(np.uint64)
    return levels


def profiles(rows: DataFrame, size: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """Per row of (doc_id, text): set size n, set key, prefix and its key, parity bitmap."""
    shift = np.uint64(64 - BUCKET_BITS)
    small = levels.astype(np.uint8)
    salts = [np.uint64(x) for x in (0x1234567, 0x89ABCDEF01, 0x5DEECE66D, 0xB5297A4D)]

    def profile(s: np.ndarray) -> tuple:
        n = len(s)
        order = (small[(s >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(60)) | (s >> np.uint64(4))
        prefix = np.sort(order)[: n - (num * n + den - 1) // den + 1] if n else order
        keys = [int(mix(s ^ c).sum(dtype=np.uint64)) for c in salts[:2]]
        keys += [int(mix(prefix ^ c).sum(dtype=np.uint64)) for c in salts[2:]]
        parity = np.bincount((s % np.uint64(MAP_BITS)).astype(np.int64), minlength=MAP_BITS) & 1
        return n, prefix.view(np.int64), keys, np.packbits(parity.astype(np.uint8)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [profile(s) for s in shingle_sets(part.column(1), size)]
                keys = [pa.array(np.array([f[2][i] for f in found], np.uint64).view(np.int64)) for i in range(4)]
                maps = [pa.array(np.array([f[3][i] for f in found], np.int64)) for i in range(len(MAPS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.int64()), *keys, *maps,
                     pa.array([f[1] for f in found], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "k1", "k2", "g1", "g2", *MAPS, "prefix"],
                )

    id_type = dict(rows.dtypes)["doc_id"]
    longs = ", ".join(f"{c} long" for c in ["n", "k1", "k2", "g1", "g2", *MAPS])
    return rows.mapInArrow(run, f"doc_id {id_type}, {longs}, prefix array<long>")


def could_link(a: str, b: str, num: int, den: int) -> Column:
    """Size and bitmap filters on columns `<a>n`, `<a>b0`.. and `<b>n`, .. : false only where no link is possible."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    need = F.ceil(num * (na + nb) / F.lit(num + den))
    differ = sum((F.bit_count(F.col(f"{a}{m}").bitwiseXOR(F.col(f"{b}{m}"))) for m in MAPS), F.lit(0))
    sizes = (den * F.least(na, nb)) >= (num * F.greatest(na, nb))
    return sizes & (differ <= na + nb - 2 * need)


def prefixed(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.withColumnsRenamed({c: prefix + c for c in frame.columns})


def verified(pairs: DataFrame, rows: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of ids that link. Sets are made anew from the texts of the ids in question."""
    pairs = stage(pairs.select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = [s.tobytes() for s in shingle_sets(part.column(1), size)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["id", "set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(den * shared >= num * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    id_type = dict(rows.dtypes)["doc_id"]
    texts = rows.join(ids, rows["doc_id"] == ids["id"], "left_semi")
    sets = stage(texts.mapInArrow(make, f"id {id_type}, set binary"), "sets")
    joined = pairs.join(prefixed(sets, "x_"), F.col("a") == F.col("x_id")).join(
        prefixed(sets, "y_"), F.col("b") == F.col("y_id")
    )
    found = joined.select("a", "b", "x_set", "y_set").mapInArrow(check, f"a {id_type}, b {id_type}")
    links = stage(found.distinct(), "links")
    discard(pairs, sets)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots; root is the smallest of its component.

    Alternating large-star and small-star steps; every step is written, so
    lineage stays short.
    """
    both = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        met = near.join(least, near["a"] == least["u"])
        if large:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    edges = stage(edges.select("a", "b").where("a <> b"), "edges")
    while True:
        large = stage(star(edges, True), "large")
        small = stage(star(large, False), "small")
        discard(edges, large)
        edges = small
        # Done when only stars are left: one edge out of each leaf, none out of a root.
        ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
            edges.select("b", F.lit(0), F.lit(1))
        ).groupBy("v").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.where("out > 1 or (out = 1 and into = 1)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components `roots` after more links: only the classes that these join are worked on."""
    at = prefixed(roots, "p_"), prefixed(roots, "q_")
    between = links.join(at[0], F.col("a") == F.col("p_node"), "left").join(
        at[1], F.col("b") == F.col("q_node"), "left"
    ).select(F.coalesce("p_root", "a").alias("a"), F.coalesce("q_root", "b").alias("b")).distinct()
    top = components(between)
    higher = prefixed(top, "t_")
    lower = roots.join(higher, F.col("root") == F.col("t_node"), "left").select(
        "node", F.coalesce("t_root", "root").alias("root")
    )
    return stage(lower.union(top), "roots")


def named_rows(docs: DataFrame, id_col: str, node: str = "__node") -> tuple[DataFrame, DataFrame | None]:
    """Rows with an id, and those without one, written with an id above all others as `node` (none: None)."""
    known, lost = docs.where(F.col(id_col).isNotNull()), docs.where(F.col(id_col).isNull())
    if lost.isEmpty():
        return known, None
    top = docs.agg(F.max(id_col)).first()[0]
    row = F.monotonically_increasing_id()
    if dict(docs.dtypes)[id_col] == "string":
        name = F.concat(F.lit((top or "") + "\U0010FFFF"), F.lpad(row.cast("string"), 20, "0"))
    else:
        name = row + F.lit(0 if top is None else int(top) + 1)
    return known, stage(lost.withColumn(node, name), "without-id")


def ngram_join(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id. Texts link when den * intersection >= num * union."""
    known, lost = named_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id")
    whole = F.coalesce("text", F.lit("")).alias("text")
    rows = known.select("doc_id", whole)
    if lost is None:
        return linked(rows, size, num, den)
    found = linked(rows.union(lost.select("__node", whole)), size, num, den)
    made = lost.agg(F.min("__node")).first()[0]
    name = lambda c: F.when(F.col(c) < F.lit(made), F.col(c)).cast(dict(rows.dtypes)["doc_id"]).alias(c)
    return found.select(name("doc_id"), "n_shingles", name("component_id"))


def linked(rows: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """`ngram_join` of rows (doc_id, text) without nulls."""
    levels = common_levels(rows.select("text"), size)
    facts = stage(profiles(rows, size, num, den, levels), "profiles")

    # Units: one per set, named by its smallest id. Groups: one per prefix and size.
    sets = facts.where("n > 0").groupBy("n", "k1", "k2").agg(
        F.min("doc_id").alias("uid"), F.count(F.lit(1)).alias("copies")
    )
    sets = stage(sets, "units")
    mine = facts.join(sets, ["n", "k1", "k2"]).where("doc_id = uid")
    units = stage(mine.select("uid", "n", "k1", "k2", "g1", "g2", *MAPS).distinct(), "unit-facts")
    groups = units.groupBy("n", "g1", "g2").agg(F.min("uid").alias("gid"))
    members = stage(units.join(groups, ["n", "g1", "g2"]).select("uid", "gid", "n", "k1", "k2", *MAPS), "members")
    heads = members.where("uid = gid").select("gid", "n", *MAPS)
    keys = members.where("uid = gid").select("gid", F.col("n").alias("h_n"), F.col("k1").alias("h1"), F.col("k2").alias("h2"))
    same_set = (F.col("doc_id") == F.col("gid")) & (F.col("n") == F.col("h_n"))
    same_set = same_set & (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2"))
    postings = facts.join(keys, same_set).select("gid", F.posexplode("prefix").alias("pos", "token"))

    # A list of one group can link nothing: only shared shingles go on.
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("token")
    shared = stage(postings.join(lists, "token"), "shared")

    # Two partners of each group per posting list; the closest possible one is verified.
    pick = F.xxhash64("token", "gid")
    picked = shared.groupBy("token").agg(F.min_by("gid", pick).alias("p"), F.max_by("gid", pick).alias("q"))
    met = shared.select("token", "gid").join(picked, "token")
    partners = met.select("gid", F.explode(F.array("p", "q")).alias("partner")).where("gid <> partner").distinct()
    differ = sum((F.bit_count(F.col(f"x_{m}").bitwiseXOR(F.col(f"y_{m}"))) for m in MAPS), F.lit(0))
    # Unrelated large sets differ in about half the bits: they are left to the pairs across classes.
    close = partners.join(prefixed(heads, "x_"), F.col("gid") == F.col("x_gid")).join(
        prefixed(heads, "y_"), F.col("partner") == F.col("y_gid")
    ).where(could_link("x_", "y_", num, den) & (differ < 0.43 * MAP_BITS))
    near = F.shiftleft((differ + F.abs(F.col("x_n") - F.col("y_n"))).cast("long"), 32) + F.pmod(
        F.xxhash64("gid", "partner"), F.lit(1 << 31)
    )
    close = stage(close.select(
        F.least("gid", "partner").alias("a"), F.greatest("gid", "partner").alias("b"), near.alias("near")
    ).distinct(), "close")
    inside = members.join(prefixed(heads, "y_"), F.col("gid") == F.col("y_gid")).where("uid <> gid")
    inside = inside.withColumnsRenamed({c: f"x_{c}" for c in ("n", *MAPS)}).where(could_link("x_", "y_", num, den))
    inside = inside.select(F.least("uid", "gid").alias("a"), F.greatest("uid", "gid").alias("b"))

    def closest(pairs: DataFrame) -> DataFrame:
        sides = pairs.union(pairs.select("b", "a", "near"))
        best = sides.groupBy("a").agg(F.min_by("b", "near").alias("b"))
        return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    roots = components(verified(closest(close).union(inside), rows, size, num, den))
    # Classes of a large family meet through their next partners before pairs are listed.
    tried = closest(close)
    for _ in range(MEETINGS):
        at = prefixed(roots, "p_"), prefixed(roots, "q_")
        open_pairs = close.join(tried, ["a", "b"], "left_anti").join(at[0], F.col("a") == F.col("p_node"), "left").join(
            at[1], F.col("b") == F.col("q_node"), "left"
        ).where(F.coalesce("p_root", "a") != F.coalesce("q_root", "b")).select("a", "b", "near")
        chosen = stage(closest(open_pairs), "chosen")
        if chosen.isEmpty():
            break
        roots = merged(roots, verified(chosen, rows, size, num, den))
        tried = tried.union(chosen)

    # Lists with more than one class: all pairs across classes.
    classed = members.join(roots, members["uid"] == roots["node"], "left").select(
        "uid", "gid", "n", *MAPS, F.coalesce("root", "uid").alias("class")
    )
    classed = stage(classed, "classed")
    spans = classed.groupBy("gid").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    # Group members share their whole prefix, so a group of several classes is a list by itself.
    alone = postings.join(spans.where("lo <> hi").select("gid"), "gid", "left_semi").join(lists, "token", "left_anti")
    live = shared.union(alone.select(*shared.columns)).join(spans, "gid")
    opened = live.groupBy("token").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least <> most")
    entries = live.select(*shared.columns).join(opened.select("token"), "token").join(classed, "gid")
    entries = stage(entries.drop("gid"), "entries")
    x, y = prefixed(entries, "x_"), prefixed(entries, "y_")
    need = F.ceil(num * (F.col("x_n") + F.col("y_n")) / F.lit(num + den))
    # A shared shingle at these places leaves room for so much overlap before and after it.
    room = F.least("x_pos", "y_pos") + F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    met = x.join(
        y,
        (F.col("x_token") == F.col("y_token")) & (F.col("x_uid") < F.col("y_uid"))
        & (F.col("x_class") != F.col("y_class")) & could_link("x_", "y_", num, den) & (room >= need),
    ).groupBy(F.col("x_uid").alias("a"), F.col("y_uid").alias("b"), "x_n", "y_n").agg(F.count(F.lit(1)).alias("common"))
    # Up to the end of the shorter-reaching prefix all shared shingles are counted in `common`;
    # of one of the two sets, only the ceil(t n) - 1 shingles after its prefix can add to them.
    after = F.ceil(num * F.greatest("x_n", "y_n") / F.lit(den)) - 1
    more = verified(met.where(F.col("common") + after >= need).select("a", "b"), rows, size, num, den)
    discard(shared, entries)
    if not more.isEmpty():
        roots = merged(roots, more)

    # Back to rows: only sets with copies or links need a partner.
    final = sets.join(roots, sets["uid"] == roots["node"], "left").where("copies > 1 or root is not null").select(
        "n", "k1", "k2", F.coalesce("root", "uid").alias("component")
    )
    return facts.select("doc_id", "n", "k1", "k2").join(final, ["n", "k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents whose id is their component's id, with all their columns."""
    node = max(docs.columns, key=len) + "_node"  # no column of docs has this name
    known, lost = named_rows(docs, id_col, node)
    whole = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    rows = known.select(F.col(id_col).alias("doc_id"), whole)
    if lost is not None:
        rows = rows.union(lost.select(F.col(node).alias("doc_id"), whole))
    going = stage(linked(rows, size, num, den).where("doc_id <> component_id").select(
        F.col("doc_id").alias("__id")).distinct(), "near-copies")
    left = known.join(going, known[id_col] == going["__id"], "left_anti")
    if lost is None:
        return left
    return left.union(lost.join(going, lost[node] == going["__id"], "left_anti").select(*docs.columns))
