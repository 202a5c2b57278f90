"""Quality rules with thresholds learned per language and source.

Every document gets whole-text counts. Each rule metric is summarised, per
(language, source), by a mergeable quantile sketch: counts of values rounded
down to six significant bits (exact below 64, relative error at most 1/32
above). Merging two sketches is adding counts, so sketches of sources merge
into those of languages and of the corpus. A group of fewer than `min_rows`
documents takes its language's thresholds, a small language the corpus's. The
fence of a metric is quartile +/- `reach` times the quartile range, which is at
least the metric's floor, so a uniform source does not reject its own noise.
Documents are then joined with their thresholds and filtered.

Defined results: null or empty text has no words and fails the base rule; null
language or source is a group of its own; ties and repeated rows are judged
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hearsay.functions.lookup import let
from hearsay.llm.common import SPACE, join_small, keep_rows, row_key, stage, words_of

WINDOW = 5
MIN_ROWS = 200
REACH = 3
# Metric: (smallest quartile range, fence below the lower quartile too).
METRICS = {"symbol_pm": (20, False), "dup_line_pm": (150, False), "word_len_pc": (200, True)}


def repeat_words(words: Column) -> Column:
    """Words inside some window of five words that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        def of_sorted(pairs: Column) -> Column:
            twice = F.filter(
                pairs,
                lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]).eqNullSafe(True)
                | (p["h"] == F.get(pairs, i + 1)["h"]).eqNullSafe(True),
            )
            places = F.array_sort(F.transform(twice, lambda p: p["i"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(
                places, start,
                lambda acc, p: F.struct(
                    p.alias("last"),
                    (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"),
                ),
                lambda acc: acc["n"],
            )

        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
        ).otherwise(let(F.array_sort(pairs), of_sorted))

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, covered))


def text_counts(text: Column) -> Column:
    """Struct of the whole-text counts; null counts as no text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return let(
        words_of(text),
        lambda words: let(
            lines,
            lambda ls: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                repeat_words(words).alias("n_repeat_words"),
            ),
        ),
    )


def with_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Counts and metrics per document, written once: texts are read once."""
    columns = [id_col, lang_col, source_col, text_col]
    rows = docs.select(
        F.inline(F.array(F.struct(
            F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
            F.col(source_col).alias("source"), row_key(*columns).alias("__key"),
            text_counts(F.col(text_col)).alias("c"),
        )))
    ).select("doc_id", "lang", "source", "__key", "c.*")
    return stage(rows.select(
        "*",
        F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words").alias("base_failed"),
        F.expr("1000 * n_symbols div greatest(word_chars, 1L)").alias("symbol_pm"),
        F.expr("1000 * n_dup_lines div greatest(n_lines, 1L)").alias("dup_line_pm"),
        F.expr("100 * word_chars div greatest(n_words, 1L)").alias("word_len_pc"),
    ), "counts")


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, metric, value, n): the quantile sketches of documents that pass the base rule."""
    names = ", ".join(f"'{m}', {m}" for m in METRICS)
    long = rows.where("not base_failed").selectExpr("lang", "source", f"stack({len(METRICS)}, {names}) as (metric, v)")
    value = F.expr("v - v % shiftleft(1L, greatest(length(bin(v)) - 6, 0))")
    return long.groupBy("lang", "source", "metric", value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))


def quartiles(parts: DataFrame, *keys: str) -> DataFrame:
    """Per key and metric: n, q1, q3 (the smallest value with that share at or below it)."""
    each = Window.partitionBy(*keys, "metric")
    upto = each.orderBy("value")
    ranked = parts.withColumn("below", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(each))
    return ranked.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.expr("4 * below >= total"), F.col("value"))).alias("q1"),
        F.min(F.when(F.expr("4 * below >= 3 * total"), F.col("value"))).alias("q3"),
    )


def fences(parts: DataFrame, *keys: str, reach: int = REACH) -> DataFrame:
    """One row per key: total, and low and high of every metric."""
    cells: list[Column] = []
    for name, (floor, two_sided) in METRICS.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(floor)) * reach
        here = F.col("metric") == name
        cells.append(F.max(F.when(here, F.col("q3") + spread)).alias(f"{name}_high"))
        low = F.col("q1") - spread if two_sided else F.lit(-1)
        cells.append(F.max(F.when(here, low)).cast("long").alias(f"{name}_low"))
    return quartiles(parts, *keys).groupBy(*keys).agg(F.max("total").alias("total"), *cells)


def thresholds(rows: DataFrame, min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """One row per (lang, source): the fences of the smallest large enough level."""
    parts = stage(sketch(rows), "sketch")
    by_lang = stage(merge_sketches(parts, "lang"), "sketch-lang")
    whole = merge_sketches(by_lang)
    limits = [f"{m}_{side}" for m in METRICS for side in ("low", "high")]

    def level(frame: DataFrame, *keys: str) -> DataFrame:
        found = fences(frame, *keys, reach=reach)
        return found.select(*keys, "total", F.struct(*limits).alias("limits"))

    own = level(parts, "lang", "source")
    lang = level(by_lang, "lang").select(
        F.col("lang").alias("l"), F.col("total").alias("lang_total"), F.col("limits").alias("lang_limits")
    )
    joined = own.join(lang, own["lang"].eqNullSafe(lang["l"]))
    # The corpus has one row of six numbers; it travels as constants.
    corpus = level(whole).first()
    everywhere = F.struct(*[F.lit(corpus["limits"][c] if corpus else None).cast("long").alias(c) for c in limits])
    chosen = F.when(F.col("total") >= min_rows, F.col("limits")).when(
        F.col("lang_total") >= min_rows, F.col("lang_limits")
    ).otherwise(everywhere)
    return stage(joined.select("lang", "source", chosen.alias("c")).select("lang", "source", "c.*"), "limits")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", min_rows: int = MIN_ROWS, reach: int = REACH,
) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the row key of `keep_rows`."""
    rows = with_counts(docs, id_col, text_col, lang_col, source_col)
    judged = join_small(rows, thresholds(rows, min_rows, reach), ["lang", "source"])
    inside = F.lit(True)
    for name in METRICS:
        inside &= F.coalesce(F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)


def keep_good(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", **options,
) -> DataFrame:
    """The documents that pass, with all their columns."""
    judged = quality_rules(docs, id_col, text_col, lang_col, source_col, **options)
    kept = judged.where("kept").select("__key").distinct()
    return keep_rows(docs, kept, [id_col, lang_col, source_col, text_col])
