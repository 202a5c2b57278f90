"""Text cleaning: entity decoding, markup, whitespace, truncation."""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay.functions.lookup import let, literal_lookup

# Whitespace is Unicode whitespace and the four ASCII separators. Java's (?U)\s
# has the first; as one predicate it is several times faster than a class that
# lists both, so the separators, which are rare, are turned into spaces first.
_SPACE_RUN = r"(?U)\s+"
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"

_TAG = "<[^>]++>"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_MAX_CODE_POINT = 0x10FFFF


def is_blank(value: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return value.isNull() | ~value.rlike(_NOT_SPACE)


def _spaces_only(value: Column) -> Column:
    """ASCII separators to spaces."""
    present = F.lit(False)
    for char in _SEPARATORS:
        present = present | value.contains(char)
    return F.when(present, F.translate(value, _SEPARATORS, " " * len(_SEPARATORS))).otherwise(value)


def empty_to_null(value: Column) -> Column:
    """As NULLIF(value, ''), which would compute a costly value twice."""
    return let(value, lambda text: F.when(text != "", text))


def collapse_spaces(value: Column) -> Column:
    """Runs of whitespace to one space, none at the ends."""
    return let(
        _spaces_only(value), lambda text: F.trim(F.regexp_replace(text, _SPACE_RUN, " "))
    )


def split_words(value: Column) -> Column:
    """Pieces between whitespace."""
    return F.array_remove(let(_spaces_only(value), lambda t: F.split(t, _SPACE_RUN)), "")


def strip(value: Column) -> Column:
    """Whitespace off both ends."""
    return let(
        _spaces_only(value), lambda text: F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    )


def truncate(value: Column, length: int) -> Column:
    """First `length` characters (not bytes)."""
    return F.substring(value, 1, length)


def _numeric_reference(body: Column) -> Column:
    """Decode `#8364;` or `#x20ac;`."""
    # Code points that HTML maps to another character; Python's decoder knows them.
    remapped = {str(n): html.unescape(f"&#{n};") for n in (0, 13, *range(0x80, 0xA0))}
    replacement = literal_lookup(remapped, "string")
    is_hex = F.lower(F.substring(body, 2, 1)) == "x"
    digits = F.regexp_extract(body, r"^#[xX]?0*([0-9a-fA-F]*)", 1)

    def decode(code: Column) -> Column:
        dropped = (
            code.between(0x1, 0x8) | code.between(0xB, 0x1F) & ~code.isin(0xC, 0xD)
            | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF)
            | (code % 0x10000 >= 0xFFFE)
        )
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(
            replacement(code.cast("string")),
            F.when(code.between(0xD800, 0xDFFF) | (code > _MAX_CODE_POINT), "\ufffd")
            .when(dropped, "")
            .otherwise(char),
        )

    code = (
        F.when(F.length(digits) > 7, F.lit(_MAX_CODE_POINT + 1))
        .when(digits == "", F.lit(0))
        .when(is_hex, F.conv(digits, 16, 10).cast("bigint"))
        .otherwise(digits.cast("bigint"))
    )
    return let(code, decode)


def _named_reference(body: Column) -> Column:
    """Decode `amp;`, `copy` or, for old names with no semicolon, a prefix of the text."""
    bare = {name: char for name, char in html5.items() if not name.endswith(";")}
    value = literal_lookup(html5, "string")
    bare_value = literal_lookup(bare, "string")
    longest_first = sorted(bare, key=len, reverse=True)

    def by_prefix(prefix: Column) -> Column:
        rest = body.substr(F.length(prefix) + 1, F.length(body))
        return F.when(prefix != "", F.concat(bare_value(prefix), rest))

    return F.coalesce(
        value(body),
        let(F.regexp_extract(body, "^(?:" + "|".join(longest_first) + ")", 0), by_prefix),
        F.concat(F.lit("&"), body),
    )


def html_unescape(value: Column) -> Column:
    """Decode named, decimal and hex character references as HTML5 does."""

    def decode(reference: Column) -> Column:
        body = reference.substr(F.lit(2), F.length(reference))
        return F.when(body.startswith("#"), _numeric_reference(body)).otherwise(
            _named_reference(body)
        )

    between = F.split(value, _REFERENCE, -1)
    references = F.regexp_extract_all(value, F.lit(_REFERENCE), F.lit(0))
    joined = F.array_join(
        F.zip_with(
            between,
            references,
            lambda text, ref: F.concat(text, F.when(ref.isNull(), "").otherwise(decode(ref))),
        ),
        "",
    )
    return F.when(value.contains("&"), joined).otherwise(value)


def clean_text(value: Column) -> Column:
    """Decode entities, then tags to spaces, then runs of whitespace to one space."""

    def untag(text: Column) -> Column:
        return F.when(text.contains("<"), F.regexp_replace(text, _TAG, " ")).otherwise(text)

    decoded = F.coalesce(html_unescape(value), F.lit(""))
    return let(let(decoded, untag), collapse_spaces)
