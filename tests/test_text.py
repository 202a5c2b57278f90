"""Cleaning, entities, times, truncation."""

import html
from datetime import datetime, timezone

from pyspark.sql import functions as F

from hearsay.functions.text import clean_text, html_unescape, is_blank, strip, truncate
from hearsay.functions.times import epoch_to_timestamp, iso_text, iso_to_timestamp
from hearsay.sources.landing import page_of_path, page_path, topic_of_path

PAGES = "/root/testdata/sf0.001/pages.parquet"


def values(spark, rows, expression):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r["x"] for r in frame.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    cases = {
        "<em>salt \t &amp;\n pepper</em>": "salt & pepper",
        None: "",
        "": "",
        "a &lt; b &gt; c": "a c",
        "a  b\x1cc\x85d": "a b c d",
        " <p></p> ": "",
        "a < b": "a < b",
        "<><b>x": "<> x",
    }
    assert values(spark, list(cases), clean_text) == list(cases.values())


def test_entities_decode_as_html5(spark):
    cases = [
        "&copy 2020", "&notit; &amp;amp; &#150; &#x20ac; &#0; &#xD800; &#99999999999; &#1;",
        "&#xfdd0; &#x1F600; &unknown; & &; &#; &#x; a&b &ltx &AMP &ampx; &notin; &#x1fffe;",
        "&CounterClockwiseContourIntegral; &#11; &#12; &#13; &#127; &#160; &NotEqualTilde;&fjlig;",
        "x &quot&quot; &#39;&#0039;", "&&amp;&copy&copy;y", "no entity",
    ]
    assert values(spark, cases, html_unescape) == [html.unescape(c) for c in cases]


def test_entities_of_given_pages(spark):
    rows = spark.read.parquet(PAGES).select("html", html_unescape(F.col("html")).alias("x")).collect()
    assert rows and all(r["x"] == html.unescape(r["html"]) for r in rows)


def test_blank_strip_truncate(spark):
    assert values(spark, [None, "", " \n　\x1f", "a"], is_blank) == [True, True, True, False]
    assert values(spark, ["  a b \x1c"], strip) == ["a b"]
    assert values(spark, ["äöü€x"], lambda c: truncate(c, 4)) == ["äöü€"]


ISO_TEXTS = [
    ("2023-11-14T22:13:20Z", "2023-11-14T22:13:20+00:00"),
    ("2023-11-14T22:13:20+02:00", "2023-11-14T20:13:20+00:00"),
    ("2023-11-14T22:13:20-0130", "2023-11-14T23:43:20+00:00"),
    ("2023-11-14 22:13:20.5", "2023-11-14T22:13:20.500000+00:00"),
    ("2023-11-14T22:13:20.1234567", "2023-11-14T22:13:20.123456+00:00"),
    ("20231114", "2023-11-14T00:00:00+00:00"),
    ("20231114T221320", "2023-11-14T22:13:20+00:00"),
    ("2023-11-14", "2023-11-14T00:00:00+00:00"),
    ("2023-11-14T22", "2023-11-14T22:00:00+00:00"),
    ("1969-12-31T23:59:59.25Z", "1969-12-31T23:59:59.250000+00:00"),
    ("2023", None), ("22:13", None), ("garbage", None), ("", None),
    ("2023-02-30", None), ("2023-11-14T25:00", None), ("2023-11-14T22:13:60", None),
]


def test_iso_text_to_utc(spark):
    got = values(spark, [t for t, _ in ISO_TEXTS], lambda c: iso_text(iso_to_timestamp(c)))
    assert got == [want for _, want in ISO_TEXTS]


def test_iso_forms_equal_python(spark):
    """Calendar and week dates, with times and offsets, as Python's own parser reads them."""
    dates = ["2023-11-14", "20231114", "2023-W46-2", "2023W462", "2023-W46", "2023W46", "2020-W53-7", "2021-W53-1",
             "2024-W01-1", "2026-W53-5", "2023-W00-1", "2023-W46-8", "2023-W462"]
    times = ["", "T22", " 22:13", "T221320", "T22:13:20.5", "T22:13:20,1234567", "T24:00", "T22:13:"]
    offsets = ["", "Z", " Z", "+02:30", "-0130", " +01", "  +01", "+02:30:15.5", "-023015,25", "+24:00", " "]
    texts = [d + t + o for d in dates for t in times for o in offsets if t or not o]

    def wanted(text):
        try:
            at = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).isoformat()

    texts += ["2023-11-14\n", "2023-W46-20", "0001-W01-1", "0001-01-01T00:00+01:00"]
    got = values(spark, texts, lambda c: iso_text(iso_to_timestamp(c)))
    differ = [(t, g, wanted(t)) for t, g in zip(texts[:-1], got, strict=False) if g != wanted(t)]
    assert not differ and got[-1] is None


def test_epoch_range(spark):
    frame = spark.createDataFrame([(1_700_000_000,), (0,), (253402300800,), (-62135596801,)], "e bigint")
    got = [r[0] for r in frame.select(iso_text(epoch_to_timestamp(F.col("e")))).collect()]
    assert got == ["2023-11-14T22:13:20+00:00", "1970-01-01T00:00:00+00:00", None, None]


def test_page_path_round_trip(spark):
    frame = spark.createDataFrame([("C++ / é", 7), ("a-b_c", 1234)], "topic string, page int")
    path = F.concat(F.lit("x/"), page_path(F.col("topic"), F.col("page")))
    rows = frame.select(path, topic_of_path(path), page_of_path(path)).collect()
    assert [tuple(r) for r in rows] == [
        ("x/C_____é/page_007.json", "C_____é", 7), ("x/a-b_c/page_1234.json", "a-b_c", 1234),
    ]
