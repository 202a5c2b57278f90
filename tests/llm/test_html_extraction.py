"""Main text of pages: markup, differencing of pages without an article, copies, edges, and the given table."""

import html
import random
import re

import pytest

from hearsay.llm.html_extraction import aligned, main_text, neighbours, without_frame
from hearsay.llm.page_lines import judged_lines, page_lines

SF = "/root/testdata/sf0.001"
STORY = "This is a longer line of running text about subject number {} and it goes on for a while."


@pytest.fixture(autouse=True)
def several_partitions(spark):
    """Small tables stay in several partitions, so that borders are crossed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_page(n, story=None):
    """A page whose markup says nothing: menu, notice, story and foot are all divs."""
    lines = ["Home", "News", "Contact us", "We value your privacy, see what we do with it", f"Title {n}",
             *(story or [STORY.format(f"{n}{x}") for x in "abc"]), "Imprint", "All rights reserved"]
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"


def own(n, story=None):
    return "\n\n".join([f"Title {n}", *(story or [STORY.format(f"{n}{x}") for x in "abc"])])


def table(spark, rows):
    # Extra columns bear names that the operator uses itself.
    return spark.createDataFrame([(*r, "h", 1, True) for r in rows],
                                 "page_id long, url string, html string, host string, rid int, settled boolean")


def texts(frame):
    assert frame.columns == ["page_id", "url", "text", "n_chars"]
    rows = frame.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def test_markup():
    page = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><a>Menu</a></nav><div id="cookie-notice"><p>Cookies!</p></div>
    <article class="post"><header><h1>The &lt;head&gt; line</h1><p>by me</p></header><p>One <b>two<br>three</b>&nbsp;four
    <p>a &amp; b < c &copy; &#233;<script>var t="</p>";</script>x<!-- no --> y</p><div class="ad">Buy</div><ul><li>i<li>ii</ul>
    <table><tr><td>c1</div><td>c2</table><form><p>Name</p></form><aside>side</aside><p hidden>no</p><span class="promo">no
    <b>no</b></span> tail<section id="comments"><article>me too</article></section><footer>foot</footer></article>
    <footer>end</footer></body></html>"""
    assert page_lines(page)[:2] == (True, [
        "The <head> line", "One two three four", "a & b < c © éx y", "i", "ii", "c1", "c2", "tail"])


def test_article_inside_a_form_or_a_wrapper():
    inner = "<nav>m</nav><article><p>" + STORY + "</p><div class=comments>c</div></article>"
    page = lambda html: page_lines(html)[:2]
    assert page(f"<form id=all>{inner}</form>") == (True, [STORY])
    assert page(f"<div class=page-sidebar-left><p>x</p>{inner}</div>") == (True, [STORY])
    assert page(f"<div><p>{STORY * 3}</p></div><div class=related>{inner}</div>") == (False, [STORY * 3])
    assert page("<form><p>only a form</p></form>") == (False, ["only a form"])
    assert page_lines(None) == page_lines("") == page_lines("<p> </p>") == (False, [], [])
    assert page("<main><p>m</p></main><p>o</p>") == (False, ["m"])


def test_odd_markup_takes_linear_time():
    for odd in ("<a <a <a ", "<div><b>", "<!--", "<script>", "a<b c='x", "<nav><b><div><i>", "</i>"):
        page_lines(odd * 20_000)


def lcs_size(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_alignment_is_longest():
    rng = random.Random(5)
    for _ in range(800):
        a, b = ([rng.randrange(rng.choice([2, 6])) for _ in range(rng.randrange(15))] for _ in range(2))
        for held in (1 << 28, 5):
            at = aligned(a, b, held)
            rest = iter(b)
            assert at == sorted(set(at)) and all(a[i] in rest for i in at) and len(at) == lcs_size(a, b)
    assert without_frame(["a", "b"], []) == ["a", "b"]


def test_differencing(spark):
    rows = [(n, f"http://h.org/{'de' if n % 2 else 'en'}/{n}?q", plain_page(n)) for n in range(9)]
    moved = [f"A quite new passage of text that stands in {n} alone and nowhere else." for n in "pq"]
    rows += [
        # Copies show no frame: both still find another page of the site.
        (20, "http://c.org/a/1", plain_page(1)), (21, "http://c.org/a/1", plain_page(1)), (22, "http://c.org/a/9", plain_page(9)),
        (19, "http://c.org/a/0", plain_page(0, moved)),
        (30, "http://alone.org/", plain_page(3)), (31, None, plain_page(4)), (32, "nothing", plain_page(5)),
        (40, "http://same.org/x", plain_page(6)), (41, "http://same.org/y", plain_page(6)),
        (50, "http://h.org/de/5", None), (51, "http://e.org/", ""), (None, "http://h.org/en/4", "<article><p>Imprint</p></article>"),
    ]
    got = texts(main_text(table(spark, rows).repartition(3)))
    assert len(got) == len(rows)
    for n in range(9):
        assert got[n] == own(n), n
    assert got[19] == own(0, moved) and got[20] == got[21] == own(1) and got[22] == own(9)
    whole = [f"Home\n\nNews\n\nContact us\n\nWe value your privacy, see what we do with it\n\n{own(n)}\n\nImprint\n\nAll rights reserved"
             for n in range(9)]
    assert (got[30], got[31], got[32]) == (whole[3], whole[4], whole[5]) and got[40] == got[41] == whole[6]
    assert got[50] == got[51] == "" and got[None] == "Imprint"


def test_pages_with_an_article_are_differenced(spark):
    """Frame goes from them too: here teasers that markup alone takes for articles of the page."""
    teaser = "<article><h2>Most read</h2><p>The story that everyone reads, on each page of the site, every day of it.</p></article>"
    shared = STORY.format("quoted")
    page = lambda n: (f"<nav><p>Home</p></nav>{teaser}<article><h1>Title {n}</h1><p>{STORY.format(f'{n}a')}</p><p>{shared}</p>"  # noqa: E731
                      f"<p>{STORY.format(f'{n}b')}</p></article><footer>Imprint</footer>")
    rows = [(n, f"http://t.org/{n}", page(n)) for n in range(4)] + [(9, "http://one.org/", page(9))]
    want = lambda n: "\n\n".join([f"Title {n}", STORY.format(f"{n}a"), shared, STORY.format(f"{n}b")])
    got = texts(main_text(table(spark, rows)))
    assert [got[n] for n in range(4)] == [want(n) for n in range(4)]
    assert got[9].startswith("Most read") and got[9].endswith(want(9))


def test_lines_that_the_markup_drops_are_aligned():
    lines = judged_lines("<nav><p>Home</p></nav><article><p>a<b hidden>x</b>b</p></article><footer>f</footer>")
    assert (lines.every, lines.left, lines.article) == (["Home", "ab", "x", "f"], ["ab"], [1])


def test_neighbours_are_those_of_the_sorted_urls(spark):
    rng = random.Random(3)
    keys = [("big" if rng.random() < 0.6 else f"h{rng.randrange(20)}", "/".join(["", *(str(rng.randrange(4)) for _ in range(rng.randrange(5)))]), i)
            for i in range(500)]
    got = {r["rid"]: (r["near"], r["second"]) for r in neighbours(spark.createDataFrame(keys, "host string, path string, rid long")).collect()}
    line = sorted(keys)
    equal = lambda p, q: next((k for k, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q)))  # noqa: B905, E731
    for k, (host, path, rid) in enumerate(line):
        sides = [line[j] if 0 <= j < len(line) and line[j][0] == host else None for j in (k - 1, k + 1)]
        score = [-1 if s is None else equal(s[1].split("/"), path.split("/")) for s in sides]
        order = sides if score[0] >= score[1] else sides[::-1]
        assert got[rid] == tuple(s and s[2] for s in order)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = texts(main_text(pages))
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", article))
        want = [" ".join(html.unescape(b).split()) for b in blocks]
        assert got[r["page_id"]] == "\n\n".join(b for b in want if b)


def test_empty_table(spark):
    assert main_text(table(spark, [(1, "u", "h")]).limit(0)).count() == 0
