"""Main text of web pages: nearest-URL page differencing, checked by the markup.

1. Each page becomes lines (blocks of text), menus and footers included; scripts,
   styles and comments are no lines.
2. All pages are ordered by host and path. A page's nearest page is the
   neighbour in this order, of the same host, with more equal leading path
   segments (the one before, in a tie); the other neighbour is its second.
3. The lines of every page are aligned with those of its nearest page, then of its
   second, by longest common subsequence; shared lines are the site's frame and are
   deleted. A page that holds more than half of this one's running text is a copy of
   it, which shows no frame and deletes nothing.
4. The markup checks what is left. What it names as menu, header, footer, sidebar,
   notice, advert, form or comment goes too, and beside an article element all
   else. An article element with a line of its own is whole: a shared line in it is
   a quotation or a copy and comes back. One that is shared line by line (a teaser
   that stands on each page) is frame.

Ordering moves keys alone (host, path, row), differencing the hashes of lines; a
page is neighbour of at most two, so no host, however large, is a hot key. Page
sources are never shuffled, and texts only where more pages lose lines than a
broadcast may hold.

Defined results: null or empty html has an empty text; a null URL, or one without
`://`, has no host and no neighbour; repeated rows are pages of their own (and
copies of each other); an empty table gives an empty result; a page without a
neighbour keeps all that the markup does not drop; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearsay.llm.common import join_small, stage
from hearsay.llm.ordered import in_parts
from hearsay.llm.page_lines import judged_lines
from hearsay.llm.url_filter import host_of, path_of
from hearsay.llm.words import slices

# Words from which a line is running text, not a label; bits of alignment rows that are held at once.
TEXT_WORDS, HELD_BITS = 10, 1 << 28
BREAK = "\n\n"


def aligned(a: list[int], b: list[int], held_bits: int = HELD_BITS) -> list[int]:
    """Positions in `a` of a longest common subsequence of a and b.

    Equal ends are taken off and values of one side alone left out, both without
    loss. The rest is done on bit rows, halved while they would be too many.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    both = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    x = [i for i in range(head, len(a) - tail) if a[i] in both]
    y = [v for v in b[head : len(b) - tail] if v in both]
    middle = [x[i] for i in _bit_aligned([a[i] for i in x], y, held_bits)] if both else []
    return [*range(head), *middle, *range(len(a) - tail, len(a))]


def _rows(a: list[int], b: list[int], every: bool) -> list[int]:
    """Bit rows of the alignment of a's prefixes with b: a 0 in column j is a step up there. The last one, or all."""
    at: dict[int, int] = defaultdict(int)
    for j, v in enumerate(b):
        at[v] |= 1 << j
    full = row = (1 << len(b)) - 1
    rows = []
    for v in a:
        met = row & at.get(v, 0)
        row = ((row + met) | (row - met)) & full
        if every:
            rows.append(row)
    return rows if every else [row]


def _bit_aligned(a: list[int], b: list[int], held_bits: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > held_bits and len(a) > 1:
        half = len(a) // 2

        def steps(p: list[int], q: list[int]) -> np.ndarray:
            row = np.frombuffer(_rows(p, q, False)[0].to_bytes(len(q) // 8 + 1, "little"), np.uint8)
            bits = np.unpackbits(row, bitorder="little")[: len(q)]
            return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

        cut = int((steps(a[:half], b) + steps(a[half:][::-1], b[::-1])[::-1]).argmax())
        return _bit_aligned(a[:half], b[:cut], held_bits) + [
            half + i for i in _bit_aligned(a[half:], b[cut:], held_bits)
        ]
    size = len(b) // 8 + 1
    rows = [r.to_bytes(size, "little") for r in _rows(a, b, True)]
    step = lambda i, j: not rows[i][j >> 3] >> (j & 7) & 1
    found, i, j = [], len(a), len(b)
    while i and j:
        if not step(i - 1, j - 1):
            j -= 1
        else:
            i -= 1
            if not (i and step(i - 1, j - 1)):
                found.append(i)
                j -= 1
    return found[::-1]


def line_marks(lines: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(line) >> 1 for line in lines]


def frame_of(marks: list[int], at: list[int], size: list[int], article: list[int], others: list[list[int]]) -> list[int]:
    """Which of the lines that the markup leaves are frame: positions in `at`.

    `marks` are all lines of the page, `at`, `size` and `article` the place, words and article (0: none) of those that
    are left. Another page deletes nothing if it is a copy or nothing would be left.
    """
    whole = sum(n for n in size if n >= TEXT_WORDS)
    shared: set[int] = set()
    frame: list[int] = []
    for other in others:
        # As a set, so that copied passages in another order count too.
        there = set(other)
        if 2 * sum(n for n, i in zip(size, at, strict=True) if n >= TEXT_WORDS and marks[i] in there) > whole:
            continue
        more = shared.union(aligned(marks, other))
        own = {a for a, i in zip(article, at, strict=True) if a and i not in more}
        found = [k for k, (a, i) in enumerate(zip(article, at, strict=True)) if i in more and a not in own]
        if len(found) < len(at):
            shared, frame = more, found
    return frame


def without_frame(lines: list[str], others: list[list[int]]) -> list[str]:
    """The lines of a page whose markup says nothing, less the frame."""
    size = [len(line.split()) for line in lines]
    frame = frame_of(line_marks(lines), [*range(len(lines))], size, [0] * len(lines), others)
    return [line for i, line in enumerate(lines) if i not in set(frame)]


def parsed(rows: DataFrame, html: int) -> DataFrame:
    """The columns before `html`, text (the lines that the markup leaves, set apart by an empty one), marks (hashes of
    all lines), and of the lines in the text: place, words and article."""
    names = [*rows.columns[:html], "text", "marks", "at", "size", "article"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                found = [judged_lines(page) for page in part.column(html).to_pylist()]
                left = [f.left for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:html], pa.array([BREAK.join(x) for x in left], pa.string()),
                     pa.array([line_marks(f.every) for f in found], pa.list_(pa.int64())),
                     pa.array([f.at for f in found], pa.list_(pa.int32())),
                     pa.array([[len(line.split()) for line in x] for x in left], pa.list_(pa.int32())),
                     pa.array([f.article for f in found], pa.list_(pa.int32()))],
                    names=names,
                )

    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:html])
    return rows.mapInArrow(run, f"{kept}, text string, marks array<long>, at array<int>, size array<int>, article array<int>")


def equal_segments(a: Column, b: Column) -> Column:
    """How many leading path segments are equal."""
    x, y = F.split(a, "/"), F.split(b, "/")
    differ = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
    return F.when(differ == 0, F.size(x)).otherwise(differ - 1)


def neighbours(keys: DataFrame) -> DataFrame:
    """(rid, near, second): the rows next to each row of (host, path, rid) by URL; null where there is none."""
    parts = in_parts(keys.select("host", "path", "rid"), ["host", "path", "rid"], "urls")
    key = F.struct("host", "path", "rid")
    order = Window.partitionBy("part").orderBy("host", "path", "rid")
    # Neighbours across partition borders: one row per partition.
    ends = parts.groupBy("part").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    line = Window.orderBy("part")
    ends = ends.select("part", F.lag("b").over(line).alias("before"), F.lead("a").over(line).alias("after"))
    rows = parts.select("part", key.alias("key"), F.lag(key).over(order).alias("p"), F.lead(key).over(order).alias("q"))
    rows = rows.join(F.broadcast(ends), "part").select(
        "key", F.coalesce("p", "before").alias("p"), F.coalesce("q", "after").alias("q")
    )

    def near(side: str) -> Column:
        same_host = F.col(f"{side}.host") == F.col("key.host")
        return F.when(same_host, equal_segments(F.col("key.path"), F.col(f"{side}.path"))).otherwise(-1)

    other = lambda side: F.when(F.col(f"{side}.host") == F.col("key.host"), F.col(f"{side}.rid"))
    first = F.coalesce(near("p"), F.lit(-1)) >= F.coalesce(near("q"), F.lit(-1))
    return rows.select(
        F.col("key.rid").alias("rid"), F.when(first, other("p")).otherwise(other("q")).alias("near"),
        F.when(first, other("q")).otherwise(other("p")).alias("second"),
    )


def frames(lines: DataFrame) -> DataFrame:
    """(rid, frame): the lines of each text that differencing deletes; pages that lose none are left out."""
    near = neighbours(lines.where("host <> ''"))
    sides = F.inline(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("other")) for i, c in enumerate(("near", "second"))]))
    marks = lines.select(F.col("rid").alias("other"), F.col("marks").alias("met"))
    met = near.select("rid", sides).where("other is not null").join(marks, "other").groupBy("rid").agg(
        *[F.max(F.when(F.col("side") == i, F.col("met"))).alias(c) for i, c in enumerate(("near", "second"))]
    )
    own = lines.select("rid", "marks", "at", "size", "article").join(met, "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                frame_of(*page, [o for o in others if o])
                for *page, near, second in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
                for others in [(near, second)]
            ]
            keep = [i for i, f in enumerate(found) if f]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array([found[i] for i in keep], pa.list_(pa.int32()))],
                names=["rid", "frame"],
            )

    return own.mapInArrow(run, "rid long, frame array<int>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    lines = stage(parsed(rows, rows.columns.index("html")), "page-lines")
    found = join_small(lines.select("rid", "page_id", "url", "text"), stage(frames(lines), "page-frames"), ["rid"], 1)
    kept = F.filter(F.split("text", BREAK), lambda line, i: ~F.array_contains("frame", i))  # noqa: ARG005
    text = F.when(F.col("frame").isNull(), F.col("text")).otherwise(F.array_join(kept, BREAK))
    return found.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
