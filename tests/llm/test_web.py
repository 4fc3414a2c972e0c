"""WARC archives and URL filters."""

import hashlib

import pytest

from starloom.llm import url_filter, warc
from starloom.session import scratch_path


def test_archives(spark):
    long = "é" * 600
    nasty = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40 + "\r\n"
    payloads = [(1, long), (5, long), (3, long), (2, "short"), (4, "short"), (None, long), (6, nasty), (7, nasty), (8, None),
                (9, "z\r\n"), (10, ""), (None, "n" * 1000), (None, "n" * 1000), (11, "t" * 2000), (11, "t" * 2000), (12, "x" * 300_000)]
    pages = spark.createDataFrame([(i, f"http://a b/\r\n{i}", p, "q") for i, p in payloads], "page_id long, url string, html string, payload string")
    path = scratch_path(spark, "test-warc")
    got = warc.archived(pages.repartition(3), path).collect()
    expected = []
    for i, p in payloads:
        data = (p or "").encode()
        same = [k for k, q in payloads if (q or "") == (p or "") and k is not None]
        first = max(same, default=None)
        revisit = len(data) >= 1000 and first is not None and i != first
        expected.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    stored = warc.read_archives(spark, path, with_payload=True).where("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in stored} == {(p or "").encode() for _, p in payloads}
    assert warc.archived(pages.limit(0), scratch_path(spark, "test-warc")).count() == 0


ENDS = ["abc\r\n", "\r\n", "x" * 2000 + "\r\n", "a\r\nb\r\n\r\n", "\r\n" * 5, "\r", "\n", "q\r\n\r", "q\n\r\n", "\r\n\r\n\r", ""]


@pytest.mark.parametrize("html", ENDS)
def test_line_ends_at_the_end_of_an_archive(spark, html):
    """Sole, last and repeated records whose payload ends in line ends."""
    for payloads in ([html], ["first", html], [html, html], [html, "last"]):
        pages = spark.createDataFrame([(i, "http://a/", p) for i, p in enumerate(payloads)], "page_id long, url string, html string")
        path = scratch_path(spark, "test-ends")
        got = {r.page_id: r for r in warc.archived(pages.coalesce(1), path).collect()}
        assert {i: (r.payload_bytes, r.payload_digest) for i, r in got.items()} == {
            i: (len(p), hashlib.sha1(p.encode()).hexdigest()) for i, p in enumerate(payloads)
        }


def test_several_archives_in_one_task(spark):
    pages = spark.createDataFrame([(i, "http://a/", p) for i, p in enumerate(ENDS * 2)], "page_id long, url string, html string")
    path = scratch_path(spark, "test-ends")
    warc.write_archives(warc.records(pages.repartition(7)), path)
    lines = spark.read.option("lineSep", warc.GAP.decode()).schema("value string").text(path).coalesce(1)
    rows = lines.mapInArrow(lambda batches: warc._rows(batches, False), warc.READ).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(ENDS) * 2))


def test_record_over_many_chunks():
    body = b"GET\r\n\r\n" * 5000
    data = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body)
    stream = data + b"\r\n\r\n" + data
    for size in (1, 7, 4096):
        if size > 1:
            assert [b for _, b in warc.parsed(stream[i : i + size] for i in range(0, len(stream), size))] == [body, body]
    small = b"WARC/1.1\r\nContent-Length: 2\r\n\r\n\r\n\r\n\r\n\r\n\r\n"
    assert [b for _, b in warc.parsed(small[i : i + 1] for i in range(len(small)))] == [b"\r\n"]


def test_parser_refuses_broken_archives():
    with pytest.raises(ValueError):
        list(warc.parsed([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"]))
    chunks = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 2
    assert [b for _, b in warc.parsed([chunks[i : i + 1] for i in range(len(chunks))])] == [b"abc", b"abc"]


def test_verdicts_follow_aliases(spark):
    link = lambda href: f'<html><LINK href="{href}" rel=canonical></html>'
    rows = [
        (1, "http://A.Example.com/en/x?q#f", None, "a.example.com", "/en/x", "example.com/en/", "block"),
        (2, "http://www.example.com/en/", "", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (3, "https://m.org/1#t", link("http://example.com/en/2"), "m.org", "/1", None, "block"),
        (4, "http://m.org/2", '<meta http-equiv="refresh" content="0; url=/1">', "m.org", "/2", None, "block"),
        (5, "http://x.com/", link("https://m.org/1"), "x.com", "/", "com/", "allow"),
        (6, "http://free.org/", "<link <link <link", "free.org", "/", None, "allow"),
        (7, None, link("http://example.com/en/2"), "", "", None, "allow"),
        (8, "no-scheme", link("http://example.com/en/2"), "", "", None, "allow"),
        (None, "http://q.net/fr/a", "", "q.net", "/fr/a", "net/fr/", "block"),
        (3, "https://m.org/1#t", link("http://example.com/en/2"), "m.org", "/1", None, "block"),
        (9, "http://notexample.com", "", "notexample.com", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, h, "v") for i, u, h, *_ in rows], "page_id long, url string, html string, verdict string")
    got = url_filter.judged(pages).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *r) for i, _, _, *r in rows], key=repr)
    assert url_filter.judged(pages.limit(0)).count() == 0


# (url of the page, html, what the verdict must be): each page links to a blocked address in its own way, or to none
EDGES = [
    ("http://a0.org/", '<link rel="alternate canonical" href="http://block.net/fr/a">', "block"),
    ("http://a1.org/", "<link rel='canonical nofollow' href='http://block.net/fr/a'>", "block"),
    ("http://a2.org/", '<link rel="canonical-ish" href="http://block.net/fr/a">', "allow"),
    ("http://a3.org/", '<link title="a > b < c" rel=canonical href=http://block.net/fr/a>', "block"),
    ("http://a4.org/", '<link rel="canonical" href="http://block.net/es/../fr/./a">', "block"),
    ("http://a5.org/", '<link rel="canonical" href="http://block.net/x/fr/a/../../..//fr/">', "allow"),
    ("http://block.net/fr2/deep/x", '<link rel="canonical" href="../../fr/a">', "block"),
    ("http://block.net/fr3/deep/x?q=/", '<link rel="canonical" href="../fr/a">', "allow"),
    ("http://block.net/fr4", '<link rel="canonical" href="./fr/a">', "block"),
    ("http://block.net/f5/x", '<link rel="canonical" href="../../../../fr/.">', "block"),
    ("http://block.net", '<link rel="canonical" href="fr/a">', "block"),
    ("http://a6.org/", '<link rel="canonical" href="http://hub.org/?x=1&amp;y=2">', "block"),
    ("http://a7.org/", '<link rel="canonical" href="http://hub.org/?x=1&#38;y=2">', "block"),
    ("http://a8.org/", '<meta http-equiv="refresh" content="0;url=http://hub.org/?x=1&#x26;y=2">', "block"),
    ("http://a9.org/", '<link rel="canonical" href="http://hub.org/?x=1&amp;amp;y=2">', "allow"),
    ("http://hub.org/?x=1&y=2", "<meta content='3; URL=\"http://block.net/es/;v=1\"' http-equiv=Refresh>", "block"),
    ("http://b0.org/", '<link rel="canonical" href=" http://block.net/fr/a ">', "block"),
    ("http://b1.org/", '<link data-rel="canonical" href="http://block.net/fr/a">', "allow"),
    ("http://b2.org/", '<link rel="canonical" href="//block.net/fr/a#top">', "block"),
    ("http://b3.org/", '<link rel="canonical" data-href="http://block.net/fr/a" href="/">', "allow"),
    ("http://b4.org/", '<link rel="canonical" href="http://block.net/fr/a', "allow"),
    ("http://b5.org/", '<link rel="canonical" href="http://b6.org/&#1114112;&#xD800;&nope;">', "allow"),
    ("http://b7.org/", '<link rel="canonical" href="http://caf&#233;.net/es/">', "block"),
    ("http://b8.org/", "<link rel=canonical href='/?go=http://block.net/fr/a'>", "allow"),
    ("http://b9.org/?", "x" * 300_000 + "<link " * 50_000 + "\"'" * 50_000 + '<link rel="canonical" href="http://block.net/fr/a">', "block"),
    ("http://c0.org/", "<link " + "a='b' " * 30_000 + ' rel="canonical" href="http://block.net/fr/a">', "block"),
    ("http://c1.org/", f'<link rel="canonical" href="http://block.net{"/./.." * 100_000}/fr/a">', "allow"),
    ("http://c2.org/", f'<link rel="canonical" href="http://block.net{"/z" * 1000}{"/.." * 1000}/fr/a">', "block"),
]


def test_edges_of_real_pages(spark):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(EDGES)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages).collect()}
    assert {EDGES[i][0]: v for i, v in got.items()} == {u: v for u, _, v in EDGES}


def test_redirects_that_a_crawler_followed(spark):
    urls = ["http://a.org/1", "http://b.org/2", "http://c.org/3", "http://www.example.com/en/4", None]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    steps = [("http://a.org/1", "https://b.org/2#x"), ("http://b.org/2", "http://q.net/es/"), (urls[3], urls[0]), (None, urls[2])]
    followed = spark.createDataFrame(steps, "from string, to string")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages, redirects=followed).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "allow"}
