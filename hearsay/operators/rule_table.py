"""Category rules of any number, as a table with an inverted index of anchors.

Every match of most patterns holds a certain word, or a word with a certain
beginning. Such an anchor is read out of each pattern. Texts meet the rules
through their words alone: a join on the anchor gives each text the few rules
that could match, these are tried in rule order, and the first that matches
names the category. No text meets all rules. Of many rules the first in order are
met before the others, which only texts without a match among those meet.

An anchor only narrows the choice; the pattern itself decides, with the same
meaning as in `functions.category`. Patterns without an anchor (no literal word,
alternatives on the top level, lookups by number) are tried on every text, so
their number is checked.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.lookup import let
from hearsay.functions.text import is_blank
from hearsay.session import BROADCAST_ROWS
from hearsay.settings import FALLBACK_CATEGORY

MAX_LOOSE = 10_000
# Beginnings of words are indexed up to this length. Parts that a hot word is dealt over in a shuffled join.
STEM, SALTS = 8, 16
# Rules met first: so many, or this share of all where that is more; a broadcast holds them.
FIRST_RULES, FIRST_SHARE = 1_000, 1 / 64
_FLAGS = "(?iU)"
RULE = "struct<rule_order:int,pattern_order:int,category:string,pattern:string>"

# Marks in a reduced pattern: anything or nothing, a word's edge, one character that is no part of a word.
_ANY, _EDGE, _GAP = "\x01", "\x02", "\x03"
# What a pattern may not hold if it is to be reduced: marks, characters by number, quotes, back references, flags.
_ODD = r"[\x00-\x03]|\\[xu0cQENk1-9]|\(\?[a-zA-Z-]"
# Steps of the reduction, in order; each leaves a string with the same matches or more.
_STEPS = (
    (r"\\\\", _GAP),
    (r"\\[pP](?:\{[^}]*\}|[A-Za-z])", _ANY),
    (r"\[(?:[^\[\]\\]|\\.)*\]", _ANY),
    (r"\\b", _EDGE),
    (r"\\[sWtnrfh]", _GAP),
    (r"\\[ -/:-@\[-^`{-~]", _GAP),
    (r"(?s)\\.", _ANY),
    *[(r"\([^()]*\)", _ANY)] * 8,
)
_THEN = (
    (r"\.", _ANY), (r"[\^$]", _EDGE),
    (r"(?s).(?:[?*]|\{[^}]*\})[?+]?", _ANY), (r"(?s)(.)\+[?+]?", "$1" + _ANY),
)
_WORD = r"(?U)(?<=[^\w\x01])\w+(?=[^\w\x01])"
_BEGINNING = r"(?U)(?<=[^\w\x01])\w+(?=\x01|$)"
_NOT_WORD = r"(?U)\W+"


def fold(text: Column) -> Column:
    """Equal for texts that are equal but for case, in the sense of case-insensitive patterns."""
    same = F.lower(F.upper(F.lower(F.translate(text, "\u0130", "i"))))
    return F.translate(same, "\u03c2", "\u03c3")


def anchor(pattern: Column) -> Column:
    """`w:word` or `p:beginning` that a word of every matching text has; null if none is known."""
    reduced = pattern
    for what, by in _STEPS:
        reduced = F.regexp_replace(reduced, what, by)

    def pick(whole: Column) -> Column:
        plain = whole
        for what, by in _THEN:
            plain = F.regexp_replace(plain, what, by)

        def found(s: Column) -> Column:
            sized = lambda kind, extra: lambda w: F.struct((F.length(w) + extra).alias("size"), F.lit(kind).alias("kind"), w.alias("word"))
            words = F.transform(F.regexp_extract_all(s, F.lit(_WORD), F.lit(0)), sized("w:", 2))
            starts = F.transform(F.regexp_extract_all(s, F.lit(_BEGINNING), F.lit(0)), sized("p:", 0))
            return let(F.array_max(F.concat(words, starts)), lambda best: F.when(best["kind"] == "w:", F.concat(
                F.lit("w:"), fold(best["word"]))).when(best["kind"] == "p:", F.concat(
                    F.lit("p:"), F.substring(fold(best["word"]), 1, STEM))))

        return F.when(~whole.rlike(r"[\[\]()|]"), let(plain, found))

    return F.when(~pattern.rlike(_ODD), let(reduced, pick))


def anchors_of(text: Column, lengths: list[int]) -> Column:
    """All anchors that a text can meet: its words, and their beginnings of the given lengths."""

    def starts(words: Column, n: int) -> Column:
        long = F.filter(words, lambda w: F.length(w) >= n)
        return F.transform(long, lambda w: F.concat(F.lit("p:"), F.substring(w, 1, n)))

    def keys(words: Column) -> Column:
        whole = F.transform(words, lambda w: F.concat(F.lit("w:"), w))
        return F.array_distinct(F.concat(whole, *[starts(words, n) for n in lengths]))

    return let(F.array_distinct(F.split(fold(text), _NOT_WORD)), keys)


def _first_match(text: Column, rules: Column) -> Column:
    """The first of the ordered `rules` that matches, or null; later ones are not tried."""
    none = F.lit(None).cast(RULE)
    return F.aggregate(rules, none, lambda best, r: F.when(best.isNotNull(), best).when(
        F.rlike(text, F.concat(F.lit(_FLAGS), r["pattern"])), r))


def _place(rule: Column) -> Column:
    """A number that never falls in rule order; rules with equal ones stay together."""
    order = F.shiftleft(rule["rule_order"].cast("long"), 32) + F.coalesce(rule["pattern_order"].cast("long") + 2**31, F.lit(0))
    return F.coalesce(order, F.lit(-(2**63)))


def label_by_rule_table(texts: DataFrame, rules: DataFrame, text_col: str = "text", key: tuple[str, ...] = ()) -> DataFrame:
    """`texts` with `category` and `matched_term`, by `rules(rule_order, category, pattern_order, pattern)`.

    `key` names columns that tell rows apart; equal texts with equal keys share their
    candidates, which is no fault, only a hot key where a text repeats very often.
    Anchors are broadcast while their counted number is small; beyond that, words
    are shuffled to them, each dealt over `SALTS` parts.
    """
    rule = F.struct(*[F.col(f.split(":")[0]).cast(f.split(":")[1]).alias(f.split(":")[0]) for f in RULE[7:-1].split(",")])
    indexed = rules.select(anchor(F.col("pattern")).alias("anchor"), rule.alias("rule"))
    indexed = indexed.withColumn("place", _place(F.col("rule")))
    loose = indexed.where("anchor is null").select("place", "rule").limit(MAX_LOOSE + 1).collect()
    if len(loose) > MAX_LOOSE:
        raise ValueError(f"more than {MAX_LOOSE} patterns without a literal word")
    index = indexed.where("anchor is not null")
    size = F.length("anchor") - 2
    starts = F.collect_set(F.when(F.col("anchor").startswith("p:"), size))
    n, lengths = index.agg(F.count(F.lit(1)), starts).first()

    text = F.col(text_col)
    label = F.when(~is_blank(text), _first_match(text, F.col("_rules")))
    rows = texts.withColumn("_key", F.xxhash64(text, *key))
    cut = None
    if n > FIRST_RULES:
        share = min(max(FIRST_RULES / n, FIRST_SHARE), BROADCAST_ROWS / 2 / n)
        cut = index.agg(F.percentile_approx("place", share)).first()[0]
    if cut is None:
        found = _with_candidates(rows, rows, text, index, n, loose, lengths).withColumn("_rule", label)
    else:
        early, late = index.where(F.col("place") <= cut), index.where(F.col("place") > cut)
        some, few = early.agg(F.count(F.lit(1)), starts).first()
        parts = [r for r in loose if r["place"] <= cut], [r for r in loose if r["place"] > cut]
        first = _with_candidates(rows, rows, text, early, some, parts[0], few).withColumn("_rule", label).drop("_rules")
        unmatched = first.where(F.col("_rule").isNull() & ~is_blank(text)).select("_key", text)
        then = _with_candidates(first, unmatched, text, late, n - some, parts[1], lengths)
        found = then.withColumn("_rule", F.coalesce("_rule", label))
    return found.select(
        *texts.columns, F.coalesce("_rule.category", F.lit(FALLBACK_CATEGORY)).alias("category"),
        F.regexp_substr(text, F.concat(F.lit(_FLAGS), F.col("_rule.pattern"))).alias("matched_term"),
    )


def _with_candidates(
    rows: DataFrame, asked: DataFrame, text: Column, index: DataFrame, n: int, loose: list, lengths: list[int]
) -> DataFrame:
    """`rows` with `_rules`, in rule order: those of the `n` in `index` whose anchor the text of `asked` has, and all `loose` ones."""
    words = asked.select("_key", F.explode(anchors_of(text, sorted(lengths))).alias("anchor"))
    index = index.select("anchor", "rule")
    if n <= BROADCAST_ROWS:
        met = words.join(F.broadcast(index), "anchor")
    else:
        # With a hint, as the copies would look small and be broadcast.
        salted = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        words = words.withColumn("_salt", F.pmod("_key", F.lit(SALTS)).cast("int"))
        met = words.join(salted, ["anchor", "_salt"])
    chosen = met.groupBy("_key").agg(F.collect_set("rule").alias("_met"))
    always = F.from_json(F.lit(json.dumps([r["rule"].asDict() for r in loose])), f"array<{RULE}>")
    every = F.array_sort(F.concat(F.coalesce("_met", F.array().cast(f"array<{RULE}>")), always))
    return rows.join(chosen, "_key", "left").withColumn("_rules", every).drop("_met")
