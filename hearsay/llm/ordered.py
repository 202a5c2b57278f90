"""Running aggregates and stream steps over sorted rows, without a group in one task.

A frame is dealt by ranges of its group and order, and written with its
partition number, so the numbers stay. Rows of one group then lie in neighbouring
partitions: aggregates run inside each (partition, group), and what earlier
partitions hold of the same group is carried over. Only the first and the last
group of a partition can go on elsewhere, so the carried table has at most two
rows per partition, however large a group is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearsay.llm.common import same, stage

# How a running value joins what was carried over.
JOINED: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda a, b: a + b,
    "bit_xor": lambda a, b: a.bitwiseXOR(b),
}


def in_parts(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The frame dealt by ranges of the keys, with its partition number as `part`."""
    return stage(frame.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)


def running(frame: DataFrame, group: str, order: list[str], values: dict[str, tuple[str, str]], name: str) -> DataFrame:
    """The frame with running aggregates per group, each row's own value included.

    `values` maps a new column to (kind, column), kind being `sum` or `bit_xor` of a
    long column without nulls. Rows equal in group and order are interchangeable.
    """
    parts = in_parts(frame, [group, *order], name)
    agg = lambda c: getattr(F, values[c][0])(values[c][1])
    upto = Window.partitionBy("part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.select("*", *[agg(c).over(upto).alias(c) for c in values])

    ends = parts.groupBy("part").agg(F.min(group).alias("a"), F.max(group).alias("b"))
    edges = ends.select(F.explode(F.array("a", "b")).alias(group)).distinct()
    held = parts.join(F.broadcast(edges), same(parts, edges, [group]), "left_semi")
    totals = held.groupBy("part", group).agg(*[agg(c).alias(f"__{c}") for c in values])
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("part", group, *[
        getattr(F, values[c][0])(f"__{c}").over(before).alias(f"__{c}") for c in values
    ]).where(F.col(f"__{next(iter(values))}").isNotNull())
    joined = local.join(F.broadcast(carried), same(local, carried, ["part", group]), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *[local[c] for c in frame.columns],
        *[JOINED[values[c][0]](local[c], F.coalesce(carried[f"__{c}"], zero)).alias(c) for c in values],
    )
