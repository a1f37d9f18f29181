"""WARC round trips and main-text extraction."""
import base64
import gzip
import hashlib
import html as h
import io
import re

import pytest
from pyarrow import fs

from feedlake.llm import extraction, queries, warc
from tests.conftest import SF0001


def truth(rows):
    best = {}
    for page, _, text in rows:
        best[text or ""] = max(best.get(text or "", page), page)
    out = {}
    for page, _, text in rows:
        raw, first = (text or "").encode(), best[text or ""] == page
        out[page] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if first else "revisit", None if first else best[text or ""])
    return out


def test_warc_cases(spark, tmp_path):
    rows = [(1, "http://a/", None), (2, None, ""), (3, "http://ü/ x\n", "<p>é" * 400_000), (4, "u", "<p>é" * 400_000),
            (6, "u%20", "WARC/1.1\r\nWARC-Type: x\r\n\r\n"), (5, "u", "plain"), (7, "u", "plain"), (8, "u", "plain")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    folder = f"file://{tmp_path}"
    got = warc.round_trip(df, folder).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == truth(rows)
    by = {r.page_id: r for r in got}
    assert bytes(by[4].payload).decode() == rows[3][2] and by[3].payload is None
    assert by[3].url == "http://ü/ x%0A" and by[2].url is None and by[6].url == "u%20"
    archives = [x for x in (tmp_path / "warc").iterdir() if x.name.endswith(".gz")]
    assert archives and not (tmp_path / "monolithic").exists()
    # members can also be read as one file by any gzip reader
    assert sum(gzip.decompress(a.read_bytes()).count(b"WARC-Record-ID") for a in archives) == len(rows) + len(archives)


def test_warc_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "x"), (2, "u", "x"), (2, "u", "x"), (None, "u", "x"), (None, "u", "y")],
                               "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in warc.round_trip(df).collect())
    assert got == [("1", "revisit", "2"), ("2", "response", "None"), ("2", "response", "None"),
                   ("None", "response", "None"), ("None", "revisit", "2")]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_normaliser_reads_any_gzip_layout():
    records = [warc.info_record("x"), *(warc.record(i, "u", b"\r\n\r\n" * i * 99_999, "response", None) for i in range(4))]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        out = io.BytesIO()
        entries = list(warc.rewrite(io.BytesIO(data), out, 6))
        raw = out.getvalue()
        assert [gzip.decompress(raw[e["offset"]:e["offset"] + e["length"]]) for e in entries] == records
        with pytest.raises(ValueError):
            list(warc.rewrite(io.BytesIO(data[:-20]), io.BytesIO(), 6))


def test_many_archives(spark, tmp_path):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    folder = f"file://{tmp_path}"
    written = warc.write_archives(warc.with_roles(pages), folder + "/m", archive=20_000)
    assert written.count() > 3
    done = warc.normalise(written, folder + "/m", folder + "/w")
    assert warc.read_records(done, folder + "/w").count() == pages.count() == done.agg({"records": "sum"}).first()[0]
    assert fs.LocalFileSystem().get_file_info(str(tmp_path / "w")).is_file is False


def test_op2_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url", "html").collect()]
    assert {r.page_id: tuple(r)[1:] for r in queries.op2_warc(spark, SF0001).collect()} == truth(rows)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site name</h1><nav><a href="/">Home</a></nav></header><div class="cookie-notice">We use cookies.</div>
<div class="ad">Buy <b>now</b></div>%s<aside>Also see</aside><div id="sidebar"><p>Side text that is long enough to count.</p></div>
<form><label>Mail</label><input><button>Go</button></form><section class="comments"><p>First! A long reader comment with many
words in it, more than the article has in any block of it.</p></section><footer>&copy; Site</footer>
<script>var t = "</p>";</script></body></html>"""
BLOCKS = ["Title & more", "A long first paragraph with <b>bold words</b> and a<br>break &mdash; it goes on\n  and on for a while.",
          "Short.", "one", "two", "Second long paragraph, also with enough words to look like an article paragraph."]
WANT = ["Title & more", "A long first paragraph with bold words and a break — it goes on and on for a while.", "Short.",
        "one", "two", "Second long paragraph, also with enough words to look like an article paragraph."]


@pytest.mark.parametrize("shell", ["<article>%s</article>", "<main>%s</main>", '<div id="content"><div class="text">%s</div></div>'])
@pytest.mark.parametrize("closed", [True, False])
def test_article_without_the_rest(shell, closed):
    end = "</p>" if closed else ""
    t, a, b, li1, li2, c = BLOCKS
    body = f"<h1>{h.escape(t)}</h1><p>{a}{end}<p>{b}{end}<ul><li>{li1}<li>{li2}</ul><p>{c}{end}"
    assert extraction.extract(PAGE % (shell % body)) == "\n".join(WANT)


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<script>x</script>", ""),
    ("<![if x]><p>Hello <b>w", "Hello w"), ("<p>a&nbsp;&lt;b&gt; &#x41;&amp;amp;</p>", "a <b> A&amp;"),
    ("<article><header><h1>Head</h1><span>by me</span></header><p>x y z</p></article>", "Head\nx y z"),
    ("<nav>only a menu</nav>", ""), ("</b></div><p>stray</i> ends</p>", "stray ends")])
def test_extraction_cases(page, want):
    assert extraction.extract(page) == want


@pytest.mark.parametrize("page,want", [
    ('<div><p class="notice">Note<p>Paragraph 1<p>Paragraph 2</div>', "Paragraph 1\nParagraph 2"),
    ('<div><p hidden>Note <b>x<p>Paragraph 1<div>Block 2</div></div>', "Paragraph 1\nBlock 2"),
    ('<ul><li class="share">Share it<li>One<li>Two</ul><p>After', "One\nTwo\nAfter"),
    ('<ul><li class="share">Share<ul><li>a<li>b</ul>c<li>One</ul>', "One"),
    ('<div class="notice"><p>Note<p>More</div><p>Text', "Text")])
def test_unclosed_skipped_elements(page, want):
    assert extraction.extract(page) == want


@pytest.mark.parametrize("shell", [
    '<article class="post category-privacy tag-search">%s</article>', '<article class="ad-free">%s</article>',
    '<article class="comment">%s</article>', '<div role="main" class="search">%s</div>',
    '<div class="content-with-sidebar"><article>%s</article></div>', '<div class="post tag-search">%s</div>',
    '<div class="layout-sidebar-right"><div class="text">%s</div></div>', '<div class="privacy"><main>%s</main></div>',
    '<form action="x.aspx"><div class="nav-wrapper"><p>Menu</div><div>%s</div></form>',
    '<form><div class="layout-sidebar"><article>%s</article></div></form>'])
def test_skipped_names_around_the_article(shell):
    t, a, b, li1, li2, c = BLOCKS
    body = f"<h1>{h.escape(t)}</h1><p>{a}</p><p>{b}</p><ul><li>{li1}<li>{li2}</ul><p>{c}</p>"
    assert extraction.extract(PAGE % (shell % body)) == "\n".join(WANT)


@pytest.mark.parametrize("rest", [
    '<div class="comment-list"><article class="comment-body"><p>%s</p></article></div>',
    '<div class="cookie-notice"><p>%s</p></div>', '<div class="ad-container"><p>%s</p></div>',
    '<section id="related-posts"><article>%s</article></section>'])
def test_long_rest_without_article_element(rest):
    text = "The article has one paragraph of some words."
    page = f"<body><div><p>{text}</p></div>" + rest % ("many more words, not of the article " * 9) + "</body>"
    assert extraction.extract(page) == text


PARAGRAPHS = "<p>A first paragraph of the article, long enough to count.</p><p>A second one, which goes on as the first did.</p>"
TWO = "A first paragraph of the article, long enough to count.\nA second one, which goes on as the first did."


@pytest.mark.parametrize("part", ['<section class="privacy">%s</section>', '<section id="related">%s</section>',
                                  '<div class="search">%s</div>', '<div class="warning"><div>%s</div></div>'])
def test_named_parts_of_an_article_stay(part):
    page = f"<article><h2 id='search'>Search</h2>{PARAGRAPHS}{part % PARAGRAPHS}<h3 id='warning'>Warning</h3><p>End.</p></article>"
    assert extraction.extract(page) == f"Search\n{TWO}\n{TWO}\nWarning\nEnd."


def test_inline_elements_of_an_article_stay():
    page = f"<article>{PARAGRAPHS}<p>He read the <span class='ad'>advert</span> aloud, <a class='social' href='/x'>twice</a>.</p></article>"
    assert extraction.extract(page) == TWO + "\nHe read the advert aloud, twice."


@pytest.mark.parametrize("rest", [
    '<div class="comment-thread">%s</div>', '<div class="user-responses">%s</div>', '<div class="ad-300x250">%s</div>',
    '<ins class="adsbygoogle"><div class="adsbygoogle">%s</div></ins>', '<div style="display: none">%s</div>',
    '<section class="comments">%s</section>', '<article class="comment">%s</article>', '<div class="newsletter-signup">%s</div>'])
def test_rest_inside_an_article_goes(rest):
    text = "<p>A reader or advertiser says a lot here, at length.</p><p>And goes on to say even more of it.</p>"
    assert extraction.extract(f"<article>{PARAGRAPHS}{rest % text}</article>") == TWO


@pytest.mark.parametrize("rest", [
    '<div class="notice">We use cookies.</div>', '<p class="alert">Please log in.</p>',
    '<div id="related"><p><a href="/1">One more story of ours to read</a></p><p><a href="/2">And one more story of ours</a></p></div>'])
def test_named_blocks_that_do_not_read_like_the_article_go(rest):
    assert extraction.extract(f"<article>{PARAGRAPHS}{rest}</article>") == TWO


def test_sibling_articles_are_joined():
    cards = '<article><a href="/1">Another story</a></article><div class="more"><article><p>A card elsewhere.</p></article></div>'
    page = f"<body><div><article>{PARAGRAPHS}</article><article><p>Part two of it, shorter.</p></article>{cards}</div></body>"
    assert extraction.extract(page) == TWO + "\nPart two of it, shorter."


def test_long_page():
    page = "<article>" + "<p>some words of a paragraph</p>" * 20_000 + "</article>"
    assert extraction.extract(page).count("\n") == 19_999


def test_main_text_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é x</p>", 1), (1, "u", "<p>é x</p>", 1), (None, None, None, None)],
                               "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in extraction.main_text(df).collect()), key=str)
    assert got == [(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0)]
    assert extraction.main_text(df.limit(0)).count() == 0


def test_op3_equals_template(spark):
    """The generated pages hold their article between <article> and its end."""
    got = {r.page_id: r for r in queries.op3_main_text(spark, SF0001).collect()}
    for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        parts = [" ".join(h.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split())
                 for p in re.split(r"</?p>|</?h\d>", body)]
        want = "\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))
