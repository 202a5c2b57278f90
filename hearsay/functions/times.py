"""Times: epoch or ISO text to a UTC timestamp, and back to ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay.functions.lookup import let

# Epoch seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799

# year, month, day or year, week, weekday | hour, minute, second, fraction | offset sign, hours,
# minutes, seconds, fraction. Before an offset, one character may follow a time without fraction,
# and any may follow six digits of a fraction.
_ISO = (
    r"^(\d{4})(?:(-?)(\d{2})\2(\d{2})|(-?)W(\d{2})(?:\5([1-7]))?)"
    r"(?:[\s\S](\d{2})(?:(:?)(\d{2})(?:\9(\d{2}))?)?(?:[.,](\d+)(?:(?<=\d{6})[^+-]+(?=[+-]))?|[\x00-\x2A,./:-\x7F](?=[+-]))?"
    r"(?:([+-])(\d{2})(?:(:?)(\d{2})(?:\15(\d{2}))?)?(?:[.,](\d+))?)?)?\z"
)
_ISO_PARTS = "$1,$3,$4,$8,$10,$11,$12,$13,$14,$16,$17,$18,$6,$7"


def epoch_to_timestamp(epoch: Column) -> Column:
    """Whole epoch seconds to a timestamp; null outside years 1 to 9999."""
    return F.when(epoch.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(epoch))


def iso_to_timestamp(value: Column) -> Column:
    """ISO-8601 text to a timestamp; no zone means UTC; null if it is not ISO."""
    text = F.replace(value, F.lit("Z"), F.lit("+00:00"))

    def build(part: Column) -> Column:
        def number(i: int) -> Column:
            return F.coalesce(F.nullif(F.get(part, F.lit(i)), F.lit("")).cast("int"), F.lit(0))

        def micros(i: int) -> Column:
            return F.rpad(F.substring(F.get(part, F.lit(i)), 1, 6), 6, "0").cast("int")

        year, week = number(0), number(12)
        by_week = F.get(part, F.lit(12)) != ""
        # Week 1 holds January 4; a week belongs to the year of its Thursday.
        january = F.make_date(year, F.lit(1), F.lit(4))
        monday = F.date_add(january, (week - 1) * 7 - F.weekday(january))
        day = F.when(
            F.year(F.date_add(monday, 3)) == year, F.date_add(monday, F.greatest(number(13), F.lit(1)) - 1)
        )
        local = F.try_make_timestamp(
            F.when(by_week, F.year(day)).otherwise(year),
            F.when(by_week, F.month(day)).otherwise(number(1)),
            F.when(by_week, F.dayofmonth(day)).otherwise(number(2)),
            number(3), number(4), number(5).cast("decimal(8,6)"), F.lit("UTC"),
        )
        ahead = (number(8) * 3600 + number(9) * 60 + number(10)).cast("bigint") * 1_000_000 + micros(11)
        shift = F.when(F.get(part, F.lit(7)) == "-", ahead).otherwise(-ahead)
        in_range = (
            (number(5) < 60) & (number(8) < 24) & (number(9) < 60) & (number(10) < 60)
        )
        total = F.unix_micros(local) + shift + micros(6)
        return F.when(
            in_range & total.between(_FIRST_SECOND * 1_000_000, (_LAST_SECOND + 1) * 1_000_000 - 1),
            F.timestamp_micros(total),
        )

    parts = F.split(F.regexp_replace(text, _ISO, _ISO_PARTS), ",", -1)
    return F.when(text.rlike(_ISO), let(parts, build))


def to_utc(epoch: Column, iso: Column) -> Column:
    """The epoch if usable, else the ISO text, else null."""
    return F.coalesce(epoch_to_timestamp(epoch), iso_to_timestamp(iso))


def iso_text(ts: Column) -> Column:
    """`2023-11-14T22:13:20+00:00`, with microseconds only when they are not zero.

    The session time zone must be UTC.
    """

    def shown(at: Column) -> Column:
        micros = F.date_format(at, "SSSSSS")
        return F.concat(
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
            F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
            F.lit("+00:00"),
        )

    return let(ts, shown)
