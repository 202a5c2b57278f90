"""Category rules: ordered patterns, the first that matches names the category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.lookup import let
from hearsay.functions.text import is_blank
from hearsay.settings import CATEGORY_RULES, FALLBACK_CATEGORY

Rules = list[tuple[str, list[str]]]

# Ignore case; \b, \d and \s follow Unicode.
_FLAGS = "(?iU)"
_MAX_PATTERNS = 10_000


def enabled_rules(rules: Rules, categories: Iterable[str]) -> Rules:
    """Rules of the configured categories, in rule order."""
    wanted = set(categories)
    return [(name, patterns) for name, patterns in rules if name in wanted]


def rules_from_table(rules: DataFrame, categories: DataFrame | None = None) -> Rules:
    """Read `rules(rule_order, category, pattern_order, pattern)`, kept to `categories`.

    Patterns become part of the query plan, so their number is checked.
    """
    if categories is not None:
        rules = rules.join(categories.select("category"), "category", "left_semi")
    rows = (
        rules.orderBy("rule_order", "pattern_order")
        .select("category", "pattern").limit(_MAX_PATTERNS + 1).collect()
    )
    if len(rows) > _MAX_PATTERNS:
        raise ValueError(f"more than {_MAX_PATTERNS} patterns")
    grouped: dict[str, list[str]] = {}
    for row in rows:
        grouped.setdefault(row["category"], []).append(row["pattern"])
    return list(grouped.items())


def _any_of(patterns: list[str]) -> str:
    """One pattern that matches where any of `patterns` does.

    A word-boundary start shared by all of them is tested once per position.
    """
    edge = r"\b"
    if all(p.startswith(edge) and "|" not in _outside_groups(p) for p in patterns):
        inner = "|".join(p.removeprefix(edge) for p in patterns)
        return f"{_FLAGS}{edge}(?:{inner})"
    return _FLAGS + "|".join(f"(?:{p})" for p in patterns)


def _outside_groups(pattern: str) -> str:
    depth, kept = 0, []
    for char in pattern:
        depth += (char == "(") - (char == ")")
        if depth == 0:
            kept.append(char)
    return "".join(kept)


def category_rules(text: Column, rules: Rules | None = None) -> Column:
    """STRUCT<category, matched_term> of `text`.

    One scan per category decides the category; only the winning category's own
    patterns are then tried, in order, for the matched term.
    """
    rules = [r for r in (CATEGORY_RULES if rules is None else rules) if r[1]]
    category = F.when(is_blank(text), FALLBACK_CATEGORY)
    for name, patterns in rules:
        category = category.when(text.rlike(_any_of(patterns)), name)

    def label(name: Column) -> Column:
        term = F.when(F.lit(False), F.lit(None).cast("string"))
        for rule, patterns in rules:
            term = term.when(name == rule, _first_match(text, patterns))
        return F.struct(name.alias("category"), term.alias("matched_term"))

    return let(category.otherwise(FALLBACK_CATEGORY), label)


def _first_match(text: Column, patterns: list[str]) -> Column:
    """Text matched by the first of `patterns`, in order, that matches."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for p in patterns:
        found = found.when(text.rlike(_FLAGS + p), F.regexp_extract(text, f"{_FLAGS}({p})", 1))
    return found
