import base64
import hashlib
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest

from shelfcast.llm.warc import (
    build_derivatives,
    digest,
    metadata_fields,
    plain_text,
    record_text,
    responses_of_pages,
)

LINES = set(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)


class Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.out.append("\n" if tag in LINES else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.out.append("\n" if tag in LINES else "")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data.replace("\n", " "))


def parsed(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(x.split()) for x in "".join(reader.out).split("\n"))
    return "\n".join(x for x in lines if x)


def test_text_agrees_with_a_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()
    whole = [p.html for p in pages if p.html and p.html.rstrip().endswith("</html>")]
    assert len(whole) > 10
    for page in whole:
        assert plain_text(page) == parsed(page)


def test_text():
    assert plain_text(None) == plain_text("") == ""
    assert plain_text("<p>a &amp; b<!-- no --><script>var x='</p>'</script> c</p>\n<p>&eacute;&#65;") == "a & b c\néA"
    assert plain_text("a < b <i>c</i>  d\n e") == "a < b c d e"
    assert plain_text("x<script>never closed") == "x"
    assert len(plain_text("<p>word</p>" * 100_000).split("\n")) == 100_000


ROWS = [
    ("<urn:uuid:1>", "http://a.example/x/", "2024-01-01T00:00:00Z",
     '<html lang="fr"><title>T &amp; t</title><a href="/y">1</a><a href="z">2</a><a href=z>3</a>', "sha1:GIVEN",
     {"content-type": "text/html", "server": "s\r\nx"}),
    ("<urn:uuid:2>", None, None, None, None, None),
    (None, "http://b.example/", None, "<p>lost", None, {}),
    ("<urn:uuid:2>", None, None, None, None, None),
]
SCHEMA = (
    "record_id string, target_uri string, date string, payload string, payload_digest string, "
    "headers map<string,string>"
)


def test_records(spark):
    responses = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS block", "2 AS refers_to")
    rows = record_text(build_derivatives(responses)).collect()
    assert len(rows) == 6
    first = {r.record_type: r for r in rows if r.refers_to == "<urn:uuid:1>"}
    meta, text = first["metadata"], first["conversion"]
    assert text.block == "T & t\n123" and text.content_type.startswith("text/plain")
    assert meta.block == (
        "title: T & t\r\nlanguage: fr\r\noutlink: http://a.example/y\r\noutlink: http://a.example/x/z\r\n"
        "source-content-type: text/html\r\nsource-server: s x\r\ntext-characters: 9\r\n"
    )
    for row in first.values():
        assert row.source_payload_digest == "sha1:GIVEN" and row.target_uri == "http://a.example/x/"
        assert row.source_headers == ROWS[0][5]
        sha = hashlib.sha1(row.block.encode()).digest()
        assert row.block_digest == f"sha1:{base64.b32encode(sha).decode()}"
        head, _, body = row.warc.partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and fields["WARC-Refers-To"] == "<urn:uuid:1>"
        assert body == row.block + "\r\n\r\n" and int(fields["Content-Length"]) == len(row.block.encode())
    assert len({r.record_id for r in rows}) == 4  # repeated responses repeat their records
    empty = [r for r in rows if r.refers_to == "<urn:uuid:2>"]
    assert {r.source_payload_digest for r in empty} == {digest(b"")} and "WARC-Date" not in empty[0].warc
    assert build_derivatives(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 400_000, "<a " * 400_000 + ">", "<a href " * 120_000 + ">", "<p" * 500_000, "<title>" * 150_000,
        "<title" * 150_000, "<html " * 150_000 + ">", "<script" * 150_000, "<script>" * 120_000, "<!--" * 250_000,
        "<a href='>" * 100_000, '<a href="x>' * 90_000 + "'", "</p " * 250_000, " \n" * 500_000,
    ],
)
def test_a_megabyte_of_open_tags_is_read_once(page):
    begun = time.perf_counter()
    metadata_fields(page, "http://a.example/", plain_text(page), {})
    assert time.perf_counter() - begun < 3


def test_open_tags_and_hidden_parts():
    assert plain_text("a <b c") == "a <b c" and plain_text("x<p>y <!-- z") == "x\ny"
    assert plain_text("a<script>b</script>c<style>d> e <i>f") == "a c"
    assert plain_text("1 < 2 <i>and</i> 3 <!-- no --> 4 <!-- never > closed") == "1 < 2 and 3 4"
    page = "<title>a <b>t</b></title><a title='x'><a href='/p>q'>l</a><A HREF=r>m</A><a href=\"unclosed"
    assert metadata_fields(page, "http://h/", "", {}) == (
        "title: a t\r\noutlink: http://h/p>q\r\noutlink: http://h/r\r\ntext-characters: 0\r\n"
    )


class Outline(HTMLParser):
    """Title, language and links, by a parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.language, self.links, self.inside = None, None, {}, False

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "title" and self.title is None:
            self.title, self.inside = "", True
        if tag == "html" and self.language is None:
            self.language = given.get("lang")
        if tag == "a" and given.get("href"):
            self.links.setdefault(given["href"])

    def handle_endtag(self, tag):
        self.inside &= tag != "title"

    def handle_data(self, data):
        if self.inside:
            self.title += data


def test_metadata_agrees_with_a_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html", "url").collect()
    whole = [p for p in pages if p.html and p.html.rstrip().endswith("</html>")]
    for page in whole:
        outline = Outline()
        outline.feed(page.html)
        outline.close()
        want = [("title", " ".join(outline.title.split()))] if outline.title is not None else []
        want += [("language", outline.language)] if outline.language else []
        want += [("outlink", link) for link in dict.fromkeys(urljoin(page.url or "", x) for x in outline.links)]
        got = metadata_fields(page.html, page.url, plain_text(page.html), {})
        assert [tuple(x.split(": ", 1)) for x in got.split("\r\n")[:-2]] == want


def test_values_cannot_begin_headers(spark):
    bad = "<urn:uuid:1>\r\nX-Bad: 1\r\n\r\nbody"
    row = (bad, "http://a/\r\nX-Bad: 2", "2024\nX-Bad: 3", "<p>x", "sha1:A\r\nX-Bad: 4", {})
    for record in record_text(build_derivatives(spark.createDataFrame([row], SCHEMA))).collect():
        head, _, body = record.warc.partition("\r\n\r\n")
        assert not [x for x in head.split("\r\n") if x.startswith("X-Bad")] and "\n" not in head.replace("\r\n", "")
        assert body == record.block + "\r\n\r\n" and "WARC-Target-URI: http://a/ X-Bad: 2\r\n" in record.warc


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>x"), (2, None, None), (None, "u", "v")], "page_id long, url string, html string")
    rows = responses_of_pages(pages).collect()
    found = build_derivatives(responses_of_pages(pages)).where("refers_to = '%s'" % rows[0].record_id).collect()
    assert {r.source_payload_digest for r in found} == {digest(b"<p>x")}
    assert rows[0].headers["host"] == "a.example" and rows[1].headers["host"] == "" and rows[2].record_id is None
    assert len(build_derivatives(responses_of_pages(pages)).collect()) == 4
