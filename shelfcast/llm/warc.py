"""WARC derivatives: metadata and plain-text conversion records from response records."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is no text, elements that end a line, marks of a record.
_HIDDEN = re.compile(
    r"<!--.*?(-->|$)|<(script|style|template|noscript)\b[^>]*>.*?(</\2\s*>|$)", re.S | re.I
)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure"
    r"|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td"
    r"|tfoot|th|thead|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE, _TITLE_END = (re.compile(x, re.I) for x in (r"<title\b[^>]*>", r"</title\s*>"))
_ANCHOR, _HTML = (re.compile(rf"<{x}\b[^>]*>", re.I) for x in ("a", "html"))
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs

RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, date string, "
    "content_type string, block_digest string, source_payload_digest string, "
    "source_headers map<string,string>, block string"
)
_COLUMNS = [part.split()[0] for part in RECORD.split(", ")]


def digest(data: bytes) -> str:
    """Labelled digest as WARC writes it: SHA-1 in base 32."""
    return f"sha1:{base64.b32encode(hashlib.sha1(data).digest()).decode()}"


def record_urn(*parts: object) -> str:
    """The same parts always give the same record id, so a task that runs again repeats it."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(map(str, parts)))}>"


# A tag ends at a ``>``. Patterns that look for one are only used up to the last ``>`` of a text:
# then every tag that begins does end, is consumed by its match, and a page of open tags is read
# once and not once for each of them.


def _tags_end(text: str) -> int:
    return text.rfind(">") + 1


def _replace_tags(pattern: re.Pattern, by: str, text: str) -> str:
    end = _tags_end(text)
    return pattern.sub(by, text[:end]) + text[end:]


def _visible(page: str) -> str:
    """A page with blanks for comments and elements whose content is no text; what is not closed
    reaches to the end."""
    end, at, out = _tags_end(page), 0, []
    for found in _HIDDEN.finditer(page, 0, end):
        out += [page[at : found.start()], " "]
        if not (found[1] or found[3]):
            return "".join(out)
        at = found.end()
    rest, comment, _ = page[end:].partition("<!--")
    return "".join([*out, page[at:end], rest, " " if comment else ""])


def plain_text(page: str | None) -> str:
    """Text of an HTML page: no markup, scripts, styles or comments; one line for each block;
    runs of blanks as one; character references resolved. In time proportional to the page."""
    text = _visible(page or "")
    text = text.replace("\r", " ").replace("\n", " ")
    text = html.unescape(_replace_tags(_TAG, "", _replace_tags(_BREAK, "\n", text)))
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def _title(page: str) -> str | None:
    """What the first title element holds. If that is not closed, no later one is."""
    if begin := _TITLE.search(page, 0, _tags_end(page)):
        if end := _TITLE_END.search(page, begin.end()):
            inner = page[begin.end() : end.start()]
            return html.unescape(" ".join(_replace_tags(_TAG, "", inner).split()))
    return None


def _within_tags(tag: re.Pattern, wanted: re.Pattern, page: str) -> Iterator[re.Match]:
    """What is wanted of each tag, in order; a quoted value may reach past the tag's end."""
    done = 0
    for found in tag.finditer(page, 0, _tags_end(page)):
        if found.start() >= done and (match := wanted.match(page, found.start())):
            done = match.end()
            yield match


def metadata_fields(page: str | None, uri: str | None, text: str, source: dict) -> str:
    """An application/warc-fields block: what the page says of itself, its outgoing links in
    order without repeats, the source's headers and the size of the text made of it."""
    page = _visible(page or "")
    fields = []
    if (title := _title(page)) is not None:
        fields.append(("title", title))
    if language := next(_within_tags(_HTML, _LANG, page), None):
        fields.append(("language", language[1]))
    links = {}
    for match in _within_tags(_ANCHOR, _LINK, page):
        target = html.unescape(next((g for g in match.groups("") if g), ""))
        try:
            target = urljoin(uri or "", target.strip())
        except ValueError:
            continue
        if target:
            links.setdefault(" ".join(target.split()))
    fields += [("outlink", link) for link in links]
    fields += [(f"source-{k}", " ".join(str(v).split())) for k, v in sorted(source.items())]
    fields.append(("text-characters", str(len(text))))
    return "".join(f"{name}: {value}\r\n" for name, value in fields)


def derive(row) -> list[tuple]:
    """The metadata and the conversion record of one response. ``row`` has record_id,
    target_uri, date, payload, payload_digest and headers."""
    page = row.payload if isinstance(row.payload, str) else None
    source = {k: v for k, v in (dict(row.headers) if row.headers is not None else {}).items() if v is not None}
    uri = row.target_uri if isinstance(row.target_uri, str) else None
    given = row.payload_digest if isinstance(row.payload_digest, str) else None
    given = given or digest((page or "").encode("utf-8", "replace"))
    text = plain_text(page)
    out = []
    for kind, content_type, block in (
        ("metadata", "application/warc-fields", metadata_fields(page, uri, text, source)),
        ("conversion", "text/plain; charset=UTF-8", text),
    ):
        ident = record_urn(kind, row.record_id, given)
        hashed = digest(block.encode("utf-8", "replace"))
        out.append(
            (ident, kind, row.record_id, uri, row.date, content_type, hashed, given, source, block)
        )
    return out


def build_derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response (record_id, target_uri, date, payload, payload_digest,
    headers): columns of RECORD. Both refer to the response, keep its URI, date and headers and
    name its payload digest, which is worked out if it is missing. A null payload is an empty
    page; rows without a record id can't be referred to and are left out; repeated responses
    give repeated records with the same ids; other columns are not read. One pass, no shuffle.
    """
    columns = ["record_id", "target_uri", "date", "payload", "payload_digest", "headers"]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [record for row in batch.itertuples(index=False) for record in derive(row)]
            yield pd.DataFrame(rows, columns=_COLUMNS)

    kept = responses.select(*columns).where(F.col("record_id").isNotNull())
    return kept.mapInPandas(build, RECORD)


def record_text(records: DataFrame) -> DataFrame:
    """``records`` with column ``warc``: each as it stands in a WARC 1.1 file. Line ends and
    other blanks in a value become one blank, so no value can begin a header of its own."""

    def header(name: str, column: str):
        value = F.trim(F.regexp_replace(column, r"\s+", " "))
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", "record_type"),
        header("WARC-Record-ID", "record_id"),
        header("WARC-Refers-To", "refers_to"),
        header("WARC-Target-URI", "target_uri"),
        header("WARC-Date", "date"),
        header("WARC-Block-Digest", "block_digest"),
        header("WARC-Source-Payload-Digest", "source_payload_digest"),
        header("Content-Type", "content_type"),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"),
    )
    return records.withColumn("warc", F.concat(head, "block", F.lit("\r\n\r\n")))


def responses_of_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a page table (page_id, url, html), built by Spark. Their payload
    digest is left to ``build_derivatives``, which writes all digests in one form."""
    payload = F.coalesce("html", F.lit(""))
    ident = F.md5(F.concat_ws("\u0000", F.lit("response"), F.col("page_id").cast("string"), "url"))
    parts = [F.substring(ident, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    headers = F.create_map(
        F.lit("page-id"), F.col("page_id").cast("string"),
        F.lit("content-type"), F.lit("text/html; charset=utf-8"),
        F.lit("content-length"), F.octet_length(payload).cast("string"),
        F.lit("host"), F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/?#]+)", 1),
    )
    return pages.select(
        F.when(
            F.col("page_id").isNotNull(), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))
        ).alias("record_id"),
        F.col("page_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        payload.alias("payload"),
        F.lit(None).cast("string").alias("payload_digest"),
        headers.alias("headers"),
    )
