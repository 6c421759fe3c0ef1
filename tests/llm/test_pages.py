"""Main text of pages and derived WARC records."""

import gzip
import html

import pytest

from skyledger.llm import html_text, warc

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header class="site">Site name <a href="/">Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div class="main-content"><h1>Head &amp; more</h1><p>First   para with <a href="x">a link</a> and <b>bold</b> text, quite long in itself.
<p>Second para, no end tag &#8212; dash &copy; long enough to be seen as text.<br>New line of it.<!-- hidden --><ul><li>Item one<li>Item two</ul>
<form><input value="x"><button>Send</button></form><div class="ad">Buy now</div></div>
<div class="sidebar"><ul><li><a href="1">Related</a></ul></div><div class="comments"><p>A reader wrote a very long comment that must not be in the article.</p></div></div>
<footer>&copy; all rights</footer></body></html>"""


def test_furniture_is_left_out():
    assert html_text.main_text(PAGE).split("\n") == [
        "Head & more", "First para with a link and bold text, quite long in itself.", "Second para, no end tag — dash © long enough to be seen as text.",
        "New line of it.", "Item one", "Item two"]


def test_sections_headings_and_link_lists():
    page = "<main><h1>Top</h1><section>" + "<p>Some text of a paragraph that is long enough.</p>" * 5 + "</section><section><h2>Sub</h2><p>Short part.</p></section>"
    page += "<ul>" + "<li><a href=1>Link text here</a></li>" * 5 + "</ul></main>"
    assert html_text.main_text(page).split("\n") == ["Top", *["Some text of a paragraph that is long enough."] * 5, "Sub", "Short part."]


SENTENCE = "Some sentence of the running text, long enough to weigh."


def test_density_chooses_from_the_whole_body():
    text = f"<div id=content><h1>Title</h1>{f'<p>{SENTENCE}</p>' * 8}</div>"
    teaser = "<div id=extra><article class=card><h3>Teaser</h3><p>Read this other piece.</p><a href=/o>more</a></article></div>"
    for page in (f"<body><div id=top><a href=/>Home</a></div>{text}{teaser}</body>", f"<body>{teaser}{text}</body>"):
        lines = html_text.main_text(page).split("\n")
        assert "Title" in lines and lines.count(SENTENCE) == 8 and "Home" not in lines


@pytest.mark.parametrize("first,second", [(6, 4), (4, 6), (5, 5), (8, 4)])
def test_a_text_in_two_articles_is_whole(first, second):
    page = f"<body><article><h1>One</h1>{f'<p>{SENTENCE}</p>' * first}</article><article><h2>Two</h2>{f'<p>{SENTENCE}</p>' * second}</article></body>"
    assert html_text.main_text(page).split("\n") == ["One", *[SENTENCE] * first, "Two", *[SENTENCE] * second]


@pytest.mark.parametrize("opening", [
    "<main class='has-sidebar'>", "<div class='content no-comments'>", "<article class='post with-header'>", "<div class=withSidebar>", "<div title='the hidden cost'>",
    '<div class="overflow-hidden">', "<main class='search'>", "<div id=page class='search'><div class=inner>"])
def test_names_do_not_bar_the_text(opening):
    page = f"<body>{opening}<div class='entry-header'><h1>Title</h1></div>{f'<p>{SENTENCE}</p>' * 5}<div class='share'>Share it</div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", *[SENTENCE] * 5]


@pytest.mark.parametrize("opening", ["<div hidden>", "<div title=x hidden=''>", "<div aria-hidden=true>", "<div class='hidden'>", "<div class=left-sidebar>", "<p class='site ad'>",
                                     "<div class='comments'>", "<div role=search>", "<div class=cookieNotice>"])
def test_named_furniture_is_left_out(opening):
    page = f"<body><div class=text>{f'<p>{SENTENCE}</p>' * 5}{opening}Not of the text, though long enough to be seen.</div></div></body>"
    assert html_text.main_text(page).split("\n") == [SENTENCE] * 5


def test_long_comments_do_not_replace_the_text():
    for many in (6, 60):
        page = f"<body><article><h1>Title</h1>{f'<p>{SENTENCE}</p>' * 5}</article><div class=comments>{'<p>A reader wrote this down here.</p>' * many}</div></body>"
        lines = html_text.main_text(page).split("\n")
        assert lines[0] == "Title" and lines.count(SENTENCE) == 5


@pytest.mark.parametrize("page,text", [("", ""), (None, ""), ("plain", "plain"), ("<p>a<b>b</p>", "ab"), ("<div><p>x", "x"), ("<script>x", ""), ("<!-- x", ""),
                                       ("<article><h1>T</h1></article>", "T"), ("a&nbsp;\t b&lt;p&gt;", "a b<p>"), ("<p>&amp;amp;</p>", "&amp;")])
def test_broken_and_small_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_pages_are_linear():
    assert html_text.main_text("<div>" * 30_000 + "end") == "end"
    assert html_text.main_text("<p>x" * 30_000).count("x") == 30_000
    assert html_text.main_text("<" * 100_000) == "<" * 100_000


def test_pages_of_the_given_structure(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows)).collect()}
    for row in rows:
        part = row.html.partition("<article>")[2].partition("</article>")[0]
        for tag in ("<h1>", "</h1>", "<p>", "</p>", "<br>"):
            part = part.replace(tag, "\0")
        lines = [" ".join(html.unescape(x.replace("<b>", "").replace("</b>", "")).split()) for x in part.split("\0")]
        assert found[row.page_id].text == "\n".join(x for x in lines if x) and found[row.page_id].n_chars == len(found[row.page_id].text)


SCHEMA = "page_id long, url string, html string"
ODD = [(1, "http://x/", PAGE), (1, "http://x/", PAGE), (2, None, None), (None, "http://y/", ""), (3, "http://z/", "<p>" + "long " * 100_000)]


def test_extraction_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    rows = html_text.extract(df.selectExpr("*", "1 AS text", "2 AS HTML_", "3 AS n_chars")).collect()
    assert [(r.page_id, r.url) for r in rows] == [r[:2] for r in ODD]
    assert [r.n_chars for r in rows][2:] == [0, 0, 499_999]
    assert html_text.extract(df.where("false")).count() == 0


def test_derived_records_point_back(spark):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 AS record", "2 AS title")
    sources = [warc.parse(r.record) for r in warc.page_responses(df).collect()]
    rows = warc.derive_records(warc.page_responses(df).selectExpr("record", "1 AS text")).collect()
    assert [r.record_type for r in rows] == ["metadata", "conversion"] * len(ODD)
    for i, row in enumerate(rows):
        source, made = sources[i // 2], warc.parse(row.record)
        assert made.get("WARC-Refers-To") == source.get("WARC-Record-ID") == row.refers_to
        assert made.get("WARC-Source-Payload-Digest") == source.get("WARC-Payload-Digest") and row.source_digest_matches
        assert made.get("WARC-Target-URI") == source.get("WARC-Target-URI") and made.get("WARC-Date") == source.get("WARC-Date")
        assert made.get("WARC-Block-Digest") == warc.digest(made.block) and int(made.get("Content-Length")) == len(made.block) == row.content_length
        if row.record_type == "metadata":
            fields = dict(warc.header_lines(made.block))
            assert all(fields[f"source-{k}"] == v for k, v in source.headers)
        else:
            assert made.block.decode() == row.text and "\t" not in row.text
    file = b"".join(r.record for r in rows)
    assert [x.data() for x in warc.read_records(file)] == [r.record for r in rows]
    assert warc.derive_records(warc.page_responses(df.where("false"))).count() == 0


def test_codings_types_and_broken_records(spark):
    body = "<html><title>Ü&amp;</title><p>é</p>".encode("latin-1")
    packed = gzip.compress(body)
    chunked = b"".join(f"{len(p):x}\r\n".encode() + p + b"\r\n" for p in (packed[:7], packed[7:])) + b"0\r\n\r\n"

    def record(http, sent, kind="response"):
        return warc.Record([("WARC-Type", kind), ("WARC-Record-ID", "<urn:x:1>"), ("Content-Length", str(len(http) + len(sent)))], http + sent).data()

    page = record(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n", chunked)
    image = record(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n", b"\x89PNG")
    rows = [(page,), (image,), (record(b"", b"x", "request"),), (b"junk",), (None,), (page[:80],), (b"WARC/1.1\r\nContent-Length: 9\r\n\r\nx",)]
    made = warc.derive_records(spark.createDataFrame(rows, "record binary")).collect()
    assert [(r.record_type, r.title, r.text) for r in made] == [("metadata", "Ü&", None), ("conversion", "Ü&", "é"), ("metadata", None, None)]
    assert made[0].source_payload_digest == warc.digest(chunked)


def test_plain_text_keeps_blocks():
    assert warc.plain_text("<div>a <b>b</b><br>c</div><script>x</script><p>d &lt; e") == "a b\nc\nd < e"
