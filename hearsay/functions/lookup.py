"""Bounded dictionaries as foldable literals, so a lookup needs no join."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A dictionary travels inside the plan, so its size is checked.
MAX_ENTRIES = 50_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_lookup(table: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """Return a function key Column -> value Column (null when the key is absent).

    Spark scans a map literal key by key, so the table is split into about one
    bucket per entry by the CRC of the key: each lookup then reads a few keys.
    """
    if len(table) > MAX_ENTRIES:
        raise ValueError(f"{len(table)} entries exceed the literal limit of {MAX_ENTRIES}")
    n = max(len(table), 1)
    buckets: list[dict[str, object]] = [{} for _ in range(n)]
    for key, value in table.items():
        buckets[zlib.crc32(key.encode("utf-8")) % n][key] = value
    literal = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")

    def lookup(key: Column) -> Column:
        bucket = (F.crc32(key.cast("binary")) % F.lit(n)).cast("int")
        return F.try_element_at(F.get(literal, bucket), key)

    return lookup
