"""Lexicon sentiment: a score in [-1, 1] and its bucket, as Column expressions.

Scoring reads only the row's own text, so it needs no shuffle and no group: a
topic or author holding a third of all rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay.functions.lookup import let, literal_lookup
from hearsay.functions.text import is_blank, split_words
from hearsay.settings import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD, SentimentRules

# Fixed value: ASCII punctuation taken off both ends of a word.
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Share of a booster's weight one, two and three words back.
_DAMPING = (1.0, 0.95, 0.9)

# Own starter lexicon; pass the published table (sources.lexicon) for real runs.
STARTER_LEXICON: dict[str, float] = {
    "amazing": 2.8, "awesome": 3.1, "awful": -2.0, "bad": -2.5, "best": 3.2, "better": 1.9,
    "broken": -2.1, "crash": -1.7, "danger": -2.4, "disappointed": -1.9, "easy": 1.9,
    "excellent": 2.7, "fail": -2.5, "failed": -2.3, "failure": -2.3, "fantastic": 2.6,
    "fraud": -2.8, "free": 2.3, "fun": 2.3, "glad": 2.0, "good": 1.9, "great": 3.1,
    "happy": 2.7, "hate": -2.7, "helpful": 1.8, "horrible": -2.5, "impressive": 2.3,
    "improve": 1.9, "improved": 2.1, "like": 1.5, "lost": -1.3, "love": 3.2, "lying": -2.4,
    "nice": 1.8, "no": -1.2, "perfect": 2.7, "poor": -2.1, "problem": -1.7, "problems": -1.7,
    "sad": -2.1, "scam": -2.7, "smart": 1.7, "success": 2.7, "terrible": -2.1, "threat": -2.4,
    "toxic": -2.3, "trust": 2.3, "ugly": -2.3, "useful": 1.9, "useless": -1.8, "win": 2.8,
    "wonderful": 2.7, "worse": -2.1, "worst": -3.1, "wrong": -2.1,
}


def _is_caps(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def scored_words(text: Column) -> Column:
    """Words with edge punctuation off; words left with two characters or fewer keep it."""

    def bare(words: Column) -> Column:
        return F.transform(
            F.transform(words, lambda w: F.btrim(w, F.lit(_EDGE))),
            lambda cut, i: F.when(F.length(cut) <= 2, F.get(words, i)).otherwise(cut),
        )

    return let(split_words(text), bare)


def _emphasis(text: Column) -> Column:
    """Weight of exclamation and question marks."""

    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    exclaim = F.least(count("!"), F.lit(4)) * 0.292
    ask = F.when(count("?") > 3, 0.96).when(count("?") > 1, count("?") * 0.18).otherwise(0.0)
    return exclaim + ask


def lexicon_score(
    text: Column,
    lexicon: Mapping[str, float] | None = None,
    rules: SentimentRules | None = None,
) -> Column:
    """Compound sentiment of `text`, four decimals; blank or null text scores 0.

    Every word is looked up once; only the words found in the lexicon are then
    weighed by the three words before them.
    """
    valence_of = literal_lookup(STARTER_LEXICON if lexicon is None else lexicon, "double")

    def hits(low: Column) -> Column:
        looked = F.transform(low, lambda w, i: F.struct(i.alias("i"), valence_of(w).alias("v")))
        return F.filter(looked, lambda hit: hit["v"].isNotNull())

    return hits_score(text, hits, rules)


def hits_score(
    text: Column, hits: Callable[[Column], Column], rules: SentimentRules | None = None
) -> Column:
    """As `lexicon_score`; `hits(low)` gives ARRAY<STRUCT<i, v>>, the places (from 0) and
    scores of the lower-case words `low` that the lexicon holds, in order.

    A word's neighbours are found among the hits next to it, so no word is looked up twice.
    """
    rules = rules or SentimentRules()
    idiom_of = literal_lookup(dict(rules.idioms), "double")
    idiom_starts = sorted({idiom.split(" ")[0] for idiom, _ in rules.idioms})
    steps = {w: rules.step for w in rules.stronger} | {w: -rules.step for w in rules.weaker}
    step_of = literal_lookup({w: s for w, s in steps.items() if " " not in w}, "double")
    long_steps = {w: s for w, s in steps.items() if " " in w}
    long_step_of = literal_lookup(long_steps, "double")

    def weigh(
        raw: Column, low: Column, found: Column, mixed_caps: Column, hit: Column, k: Column
    ) -> Column:
        i = hit["i"]

        def scored_at(shift: int) -> Column:
            """Whether the word `shift` places on is in the lexicon: then it is one of the hits next to this one."""
            step = 1 if shift > 0 else -1
            near = F.lit(False)
            for j in range(step, shift + step, step):
                near = near | F.coalesce(F.get(found, k + j)["i"] == i + shift, F.lit(False))
            return near

        def at(shift: int) -> Column:
            return F.get(low, i + shift)

        word, one, two, three = at(0), at(-1), at(-2), at(-3)

        def plain(shift: int) -> Column:
            """A neighbour that exists and is not scored itself."""
            return at(shift).isNotNull() & ~scored_at(shift)

        def phrase(first: int, last: int) -> Column:
            return F.concat_ws(" ", *[at(k) for k in range(first, last + 1)])

        def own(v: Column) -> Column:
            """The word's valence after a "no" before it, and its capitals."""
            no_before = F.coalesce(
                (one == "no") | (two == "no") | (three == "no") & one.isin("or", "nor"), F.lit(False)
            )
            no_itself = (word == "no") & scored_at(1)
            start = F.when(no_before, v * rules.negate).when(no_itself, 0.0).otherwise(v)
            shout = F.when(mixed_caps & _is_caps(F.get(raw, i)), rules.caps).otherwise(0.0)
            return let(start, lambda w: w + F.when(w > 0, shout).otherwise(-shout))

        def factor(back: int) -> Column:
            """What the word `back` before adds to, and multiplies, the valence."""
            before = at(-back)
            boost = F.coalesce(step_of(before), F.lit(0.0))
            loud = (boost != 0) & mixed_caps & _is_caps(F.get(raw, i - back))
            turn = F.when(before.isin(*rules.negations) | before.contains("n't"), rules.negate)
            if back > 1:
                near = [at(-k) for k in range(1, back)]
                so, doubt = F.lit(False), F.lit(False)
                for other in near:
                    so = so | other.isin("so", "this")
                    doubt = doubt | (other == "doubt")
                turn = (
                    F.when((before == "never") & so, 1.25)
                    .when((before == "without") & doubt, 1.0)
                    .otherwise(turn)
                )
            neutral = F.struct(F.lit(0.0).alias("add"), F.lit(0.0).alias("shout"), F.lit(1.0).alias("times"))
            return F.when(plain(-back), F.struct(
                (boost * _DAMPING[back - 1]).alias("add"),
                F.when(loud, rules.caps * _DAMPING[back - 1]).otherwise(0.0).alias("shout"),
                F.coalesce(turn, F.lit(1.0)).alias("times"),
            )).otherwise(neutral)

        def push(v: Column, f: Column) -> Column:
            added = F.when(v < 0, -f["add"]).otherwise(f["add"])
            shouted = F.when(v > 0, f["shout"]).otherwise(-f["shout"])
            return (v + added + shouted) * f["times"]

        def idioms(v: Column) -> Column:
            value = v
            if rules.idioms:
                # The first word is compared before a phrase is made; three words back there is one.
                starts = {k: at(k).isin(*idiom_starts) for k in range(-3, 1)}
                spans = ((-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2))
                value = F.coalesce(
                    F.when(starts[0] & at(2).isNotNull(), idiom_of(phrase(0, 2))),
                    F.when(starts[0] & at(1).isNotNull(), idiom_of(phrase(0, 1))),
                    *[F.when(starts[a], idiom_of(phrase(a, b))) for a, b in spans],
                    v,
                )
            if long_steps:
                for a, b in ((-3, -1), (-3, -2), (-2, -1)):
                    value = value + F.coalesce(long_step_of(phrase(a, b)), F.lit(0.0))
            return F.when(plain(-3), value).otherwise(v)

        def least(v: Column) -> Column:
            spared = F.coalesce(two.isin("at", "very"), F.lit(False))
            return F.when(plain(-1) & (one == "least") & ~spared, v * rules.negate).otherwise(v)

        def scored(v: Column) -> Column:
            pushed = F.aggregate(F.array(factor(1), factor(2), factor(3)), own(v), push)
            return let(let(pushed, idioms), least)

        skipped = step_of(word).isNotNull() | (word == "kind") & F.coalesce(
            at(1) == "of", F.lit(False)
        )
        return F.when(skipped, 0.0).otherwise(let(hit["v"], scored))

    def total(raw: Column, low: Column, found: Column) -> Column:
        caps = F.transform(raw, lambda w, i: (w != F.get(low, i)) & (w == F.upper(w)))
        facts = let(F.size(F.filter(caps, lambda c: c)), lambda loud: F.struct(
            ((loud > 0) & (loud < F.size(raw))).alias("mixed"),
            F.array_position(low, rules.contrast).alias("turn"),
        ))

        def add_up(facts: Column) -> Column:
            turn = facts["turn"]

            def weighed(hit: Column, k: Column) -> Column:
                place = hit["i"] + 1
                share = (
                    F.when((turn == 0) | (turn == place), 1.0).when(place < turn, 0.5).otherwise(1.5)
                )
                return weigh(raw, low, found, facts["mixed"], hit, k) * share

            return F.aggregate(F.transform(found, weighed), F.lit(0.0), lambda total, v: total + v)

        return F.when(F.size(found) == 0, 0.0).otherwise(let(facts, add_up))

    def squash(s: Column) -> Column:
        pushed = s + F.signum(s) * _emphasis(text)
        return let(pushed, lambda p: F.round(p / F.sqrt(p * p + rules.norm), 4))

    raw_total = let(scored_words(text), lambda raw: let(
        F.transform(raw, F.lower),
        lambda low: let(hits(low), lambda found: total(raw, low, found)),
    ))
    return F.when(is_blank(text), 0.0).otherwise(let(raw_total, squash))


def sentiment_bucket(
    text: Column,
    score: Column,
    positive: float = POSITIVE_THRESHOLD,
    negative: float = NEGATIVE_THRESHOLD,
) -> Column:
    """positive / negative / neutral; blank text is neutral whatever its score."""
    return (
        F.when(is_blank(text), "neutral")
        .when(score >= positive, "positive")
        .when(score <= negative, "negative")
        .otherwise("neutral")
    )
