"""Rows that must neither stop a query nor slow it down, each with a limit in time or memory."""

import json
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import bpe, html_text, neardup, ragged, topk, warc


def timed(limit, job):
    started = time.monotonic()
    result = job()
    assert time.monotonic() - started < limit
    return result


# --- vectors --------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_tiny_and_huge_vectors_link_by_their_direction(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.0]
    rows = [(i, [x * f for x in v], 1) for i, (v, f) in enumerate([
        (a, 1.0), (a, 1e-200), (a, 1e-310), (a, 1e200), (a, 1e307), (b, 1.0), (b, 1e-200), (b, 1e200), (a, -1e-200)])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(vectors(spark, rows)).collect()}
    assert found == {**{i: (4, 0) for i in range(5)}, **{i: (2, 5) for i in (5, 6, 7)}, 8: (0, 8)}


def plain_top(rows, k=5, every=50):
    whole = {i: [int(np.floor(256 * x)) if abs(256 * x) < 2**52 else int(256 * x) for x in v] for i, v, _ in rows}
    out = {}
    for q in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:k]
            out |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("large", [[], [(1e6, 50)], [(3e6, 51), (-2e6, 52)], [(1e4, 0), (2e7, 53)]])
def test_scores_are_exact_beyond_doubles(spark, large):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(0, 1, 6)], 1) for i in range(120)]
    for size, at in large:
        rows[at] = (at, [x * size for x in rows[at][1]], 1)
    found = topk.top_k(vectors(spark, rows), shard_rows=40, query_rows=2).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found} == plain_top(rows)


def test_a_score_beyond_64_bits_is_never_silent(spark):
    rows = [(i, [float(i), 1.0], 1) for i in range(60)]
    # the wide rows score lowest, so nothing that does not fit is among the best
    low = [*rows[:50], (50, [1.0, 0.0], 1), (51, [-1e200, 0.0], 1), *rows[52:]]
    found = topk.top_k(vectors(spark, [r for r in low if r[0]])).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [59, 58, 57, 56, 55]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(vectors(spark, [*rows, (70, [1e200, 0.0], 1)])).collect()


def test_every_candidate_is_shuffled_once(spark):
    plan = topk.top_k(vectors(spark, [(i, [1.0, float(i)], 1) for i in range(200)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FlatMapGroups" not in plan


# --- texts ----------------------------------------------------------------------


def test_special_strings_are_cut_in_one_pass():
    special = {"<|endoftext|>": 7, "<|end": 9}
    text = "a<|endoftext|>" * 200_000 + "<|end"
    parts, owners, follow = timed(5, lambda: bpe.pieces([text, ""], special))
    assert len(parts) == 200_003 and follow[0] == 7 and follow[-3:] == [9, -1, -1] and owners[-1] == 1
    assert "".join(p + {7: "<|endoftext|>", 9: "<|end", -1: ""}[f] for p, f in zip(parts, follow)) == text


@pytest.mark.parametrize("stretch", [16, 64])
def test_hashes_do_not_depend_on_stretches(monkeypatch, stretch):
    draw = np.random.default_rng(1)
    symbols = draw.integers(0, 4, 3000).astype(np.uint32)
    edges = np.sort(draw.choice(3000, 400, replace=False))
    starts, ends = edges[:-1], edges[1:]
    whole = ragged.span_hash(symbols, starts, ends)
    monkeypatch.setattr(ragged, "STRETCH", stretch)
    ragged._powers.cache_clear()
    try:
        cut = ragged.span_hash(symbols, starts, ends)
    finally:
        ragged._powers.cache_clear()
    fits = ends - starts <= stretch
    assert (cut[fits] == whole[fits]).all()
    contents = [symbols[a:b].tobytes() for a, b in zip(starts, ends)]
    for hashes in (whole, cut):
        assert len(set(zip(contents, hashes.tolist()))) == len(set(contents)) == len(set(hashes.tolist()))


def test_a_text_of_many_millions_of_characters_takes_bounded_tables():
    symbols = np.zeros(12_000_000, np.uint8)
    spans = np.arange(0, len(symbols), 40)
    ragged.span_hash(symbols[:100], spans[:2], spans[:2] + 30)
    tracemalloc.start()
    hashes = ragged.span_hash(symbols, spans, spans + 30)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(hashes.tolist())) == 1 and peak < 60_000_000
    assert len(ragged.span_hash(symbols, np.array([0]), np.array([len(symbols)]))) == 1


def test_ids_of_characters_of_any_unicode_version():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["a" + chr(c) + "B1" for c in [*range(0x1C80, 0x1C90), *range(0xA7C0, 0xA7E0), *range(0x10D40, 0x10D90), *range(0x1E5D0, 0x1E600), *range(0x2EBF0, 0x2EC00)]]
    ids, sizes = bpe.encode(texts, path)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] == expected


# --- pages ----------------------------------------------------------------------

PARAGRAPH = "<p>" + "This sentence of the article says something about its matter, and then goes on for a while. " * 4 + "</p>"
TEXT = re.sub("<[^>]*>", "", PARAGRAPH).strip()


def lines(page):
    return html_text.main_text(page).split("\n")


def test_a_page_that_stands_in_a_form():
    page = f"<body><form id=aspnetForm><input name=q><div id=content><h1>Head</h1>{PARAGRAPH * 3}</div><label>Mail</label><button>Send</button></form></body>"
    assert lines(page) == ["Head", *[TEXT] * 3]
    assert lines(f"<body><div>{PARAGRAPH * 3}</div><form><p>Write to us about anything you like here.</p><label>Mail</label></form></body>") == [TEXT] * 3


def test_labels_buttons_and_formulas_inside_sentences():
    page = f"<body><article>{PARAGRAPH}<p>Press <button>Start</button>, tick <label>the box</label> and see <math><mi>x</mi><mo>=</mo><mn>1</mn></math> there.</p>{PARAGRAPH}</article></body>"
    assert lines(page) == [TEXT, "Press Start, tick the box and see x=1 there.", TEXT]


def test_linked_paragraphs_and_sources_stay():
    sources = "<ul>" + "".join(f"<li><a href=/{i}>Source number {i} of this article</a></li>" for i in range(6)) + "</ul>"
    page = f"<body><article>{PARAGRAPH * 4}<h2>Sources</h2>{sources}</article></body>"
    assert lines(page) == [*[TEXT] * 4, "Sources", *[f"Source number {i} of this article" for i in range(6)]]
    linked = "".join(f"<p><a href=/{i}>{TEXT}</a></p>" for i in range(20))
    assert lines(f"<body><article><h1>Head</h1>{linked}</article></body>").count(TEXT) == 20


def test_the_header_of_a_section_stays():
    assert lines(f"<body><header><h2>Site</h2></header><section><header><h1>Head</h1></header>{PARAGRAPH * 3}</section></body>") == ["Head", *[TEXT] * 3]


@pytest.mark.parametrize("page", [
    "<span>" * 20_000 + "<p>x" * 20_000, "<li><b>" * 20_000, "<p><i>" * 20_000 + "</p>" * 20_000, "<table><tr><td>" * 8_000 + "x" * 100, "<form>" * 20_000, "<div>" * 30_000 + "</span>" * 30_000,
])
def test_deep_markup_is_linear(page):
    timed(8, lambda: html_text.parse(page))


# --- records --------------------------------------------------------------------


def test_chunked_bodies_are_read_in_one_pass():
    chunks = 200_000
    body = b"4\r\nabcd\r\n" * chunks + b"0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    assert timed(5, lambda: warc.payload(block))[3] == b"abcd" * chunks


def test_many_records_of_a_file_are_read_in_one_pass():
    data = b"".join(warc.response(f"http://a/{i}", "x" * 200, str(i), "2024-01-01T00:00:00Z").data() for i in range(8_000))
    records = timed(5, lambda: list(warc.read_records(data)))
    assert len(records) == 8_000 and b"".join(r.data() for r in records) == data
    with pytest.raises(ValueError):
        list(warc.read_records(data + b"rest"))


def test_different_captures_have_different_ids(spark):
    pages = [(1, "http://a/", "one"), (1, "http://a/", "two"), (1, "http://a/", None), (1, "http://a/", ""), (1, None, "one"), (1, "None", "one"), (None, None, "x"),
             (None, None, "y"), (None, None, None), (1, "http://a/", "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = warc.derive_records(warc.page_responses(df)).collect()
    sources = [r.refers_to for r in rows if r.record_type == "metadata"]
    assert len(sources) == len(pages) and len(set(sources)) == len(set(pages))
    assert len({r.record_id for r in rows}) == 2 * len(set(pages))


def test_text_of_a_conversion_equals_a_plain_walk(spark):
    """Against the parser of Python's library: all text outside unseen elements, a block a line."""
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        unseen, breaks = {"script", "style", "template", "noscript", "textarea", "title"}, {"p", "div", "li", "ul", "h1", "h2", "br", "article", "body", "html", "head", "main", "nav",
                                                                                           "footer", "header", "section", "aside", "table", "tr", "td", "form"}

        def __init__(self):
            super().__init__()
            self.out, self.shut = [""], 0

        def handle_starttag(self, tag, attrs):
            self.shut += tag in self.unseen
            self.out.append("") if tag in self.breaks | self.unseen else None

        def handle_endtag(self, tag):
            self.shut -= tag in self.unseen
            self.out.append("") if tag in self.breaks | self.unseen else None

        def handle_data(self, data):
            for i, line in enumerate(data.split("\n") if not self.shut else []):
                if i:
                    self.out.append("")
                self.out[-1] += line

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    made = [r for r in warc.derive_records(warc.page_responses(rows)).collect() if r.record_type == "conversion"]
    texts = {}
    for r in rows.collect():
        walk = Walk()
        walk.feed(r.html or "")
        texts[r.url] = "\n".join(x for x in (" ".join(line.split()) for line in walk.out) if x)
    assert len(made) == rows.count()
    same = sum(r.text == texts[" ".join(r.target_uri.split())] for r in made)
    assert same >= 0.95 * len(made)


def test_notes_are_json_of_three_columns():
    assert json.loads(warc.capture_key(None, "u", None)) == [None, "u", None]
