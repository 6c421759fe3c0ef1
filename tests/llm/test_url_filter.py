"""URL verdicts against a plain search through all rules."""

import random

import duckdb
import pytest

from skyledger.llm import url_filter
from skyledger.llm.url_filter import ALLOW, BLOCK, RULES, Rule, Trie

ODD_URLS = [
    None, "", "no scheme.org/", "http://", "https://ORG/", "http://x.org", "http://x.org?q=/es/", "ftp://Example.ORG/es/a?b#c", "http://a.example.org/en/1",
    "http://example.org/en/", "http://notexample.org/es/", "http://x..org/", "http://x.com/fr/", "http://com/de/", "http://com.de/", "http://x.com/de",
    "a://b://c.org/", "http://é.org/ß/\n?", "http://ÉX.Org#/es/", "http://x.org:80/", "http://u@x.org/es/", "http://" + "a." * 5000 + "org/" + "s/" * 5000,
]


def plain(url, rules, default=ALLOW):
    rest = url.partition("://")[2] if url else ""
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
    return host, path, best.text if best else None, best.verdict if best else default


def frame(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_odd_urls_equal_plain_search(spark):
    rows = url_filter.judge(frame(spark, ODD_URLS)).collect()
    assert {r.page_id: tuple(r)[1:] for r in rows} == {i: plain(u, RULES) for i, u in enumerate(ODD_URLS)}


@pytest.mark.parametrize("block_chars", [1, 60, url_filter.BLOCK_CHARS])
def test_many_rules_in_blocks_equal_plain_search(spark, block_chars):
    draw = random.Random(4)
    labels, segments = ["a", "b", "org"], ["", "x", "xy", "y"]
    host = lambda: ".".join(draw.choices(labels, k=draw.randint(1, 4)))
    path = lambda: "".join("/" + s for s in draw.choices(segments, k=draw.randint(0, 3)))
    rules = list({r.text: r for r in (Rule(host(), path(), draw.choice([ALLOW, BLOCK])) for _ in range(12))}.values())
    urls = [f"http://{host()}{path()}" for _ in range(200)]
    rows = url_filter.judge(frame(spark, urls), rules, BLOCK, block_chars).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == [plain(u, rules, BLOCK) for u in urls]


def test_equal_length_prefers_the_longer_host_and_repeats_the_first():
    trie = Trie([Rule("b", "/c/", ALLOW), Rule("a.b", "/", BLOCK), Rule("a.b", "/", ALLOW)])
    assert trie.best("a.b", "/c/") == 1 and trie.best("x.b", "/c/d") == 0 and trie.best("c", "/c/") == -1


def test_walk_does_not_depend_on_the_number_of_rules():
    trie = Trie(Rule(f"h{i}.org", f"/p{i}/", BLOCK) for i in range(20_000))
    assert trie.best("www.h77.org", "/p77/x") == 77 and len(trie.root.labels) == 1


def test_sql_equals_plain_search():
    pages = [(i, u) for i, u in enumerate(ODD_URLS)]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    rows = {r[0]: r[1:] for r in db.sql(url_filter.URL_SQL).fetchall()}
    assert rows == {i: plain(u, RULES) for i, u in pages}


def test_odd_tables(spark, clashing):
    page = "page_id long, url string, html string"
    assert url_filter.judge(spark.createDataFrame([], page)).collect() == []
    rows = clashing(spark.createDataFrame([(None, "http://a.org/", ""), (None, "http://a.org/", ""), (1, None, None)], page), "host", "rule", "URL")
    assert sorted(map(tuple, url_filter.judge(rows).collect()), key=repr) == [
        (1, "", "", None, ALLOW), (None, "a.org", "/", "org/", ALLOW), (None, "a.org", "/", "org/", ALLOW)]
    assert [r.verdict for r in url_filter.judge(rows, [], BLOCK).collect()] == [BLOCK] * 3
    with pytest.raises(ValueError, match="verdicts"):
        url_filter.judge(rows, [Rule("a", "/", "maybe")])
