"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

Both refer to the response they come from and to each other, and keep its target, date, HTTP
headers and digests. Record ids follow from the source's id, so a task that runs again makes the
same records. Records are rows (headers, block); they are written and read as WARC files by
Spark's text source, whose line separator is the end of a record.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plateflow.llm.frames import append, column, kept

VERSION = "WARC/1.1"
END = "\r\n"
HEADERS = "array<struct<name:string,value:string>>"
#: HTML elements that begin a line of their own.
BLOCKS = frozenset("""address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main nav ol option p pre section select summary table
tbody td tfoot th thead title tr ul""".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|</?([a-z][a-z0-9]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z0-9-]+)""", re.IGNORECASE)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.IGNORECASE | re.DOTALL)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def named(*parts: str) -> str:
    """A record id that follows from its parts."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(parts).encode('utf-8')).digest(), version=5)}>"


def plain(page: str) -> tuple[str, str, str, list[str]]:
    """(text, title, language, outlinks) of a page.

    Comments, scripts and styles are left out, tags of block elements end a line, others vanish;
    markup that the page's end cuts off is left out too. Entities are decoded after that. Lines are
    trimmed, runs of white space are one space, and empty lines go.
    """
    links: list[str] = []
    language = ""

    def replace(match: re.Match) -> str:
        nonlocal language
        name = (match[2] or "").lower()
        if name == "a":
            if found := _HREF.search(match[3]):
                links.append(html.unescape(found[1] or found[2] or found[3] or ""))
        elif name == "html" and not language and (found := _LANG.search(match[3])):
            language = found[1]
        return "\n" if name in BLOCKS else ""

    title = _TITLE.search(page)
    text = html.unescape(_MARKUP.sub(replace, page))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    heading = " ".join(html.unescape(_MARKUP.sub("", title[1])).split()) if title else ""
    return "\n".join(line for line in lines if line), heading, language, links


Header = tuple[str, str]


def response(identity: str, url: str | None, page: str, date: str, media: str) -> tuple[list[Header], str]:
    """A response record of a fetched page: its WARC headers and its block."""
    payload = page.encode("utf-8")
    block = f"HTTP/1.1 200 OK{END}Content-Type: {media}{END}Content-Length: {len(payload)}{END}{END}{page}"
    return _record("response", named("response", identity, url or "", page), date, url, [
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload))], block)


def _record(kind: str, record_id: str, date: str | None, url: str | None, more: Sequence[Header],
            block: str) -> tuple[list[Header], str]:
    data = block.encode("utf-8")
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id)]
    headers += [("WARC-Date", date)] if date else []
    headers += [("WARC-Target-URI", _one_line(url))] if url else []
    headers += [*more, ("WARC-Block-Digest", digest(data)), ("Content-Length", str(len(data)))]
    return headers, block


def _one_line(value: str) -> str:
    return " ".join(value.split())


def derivatives(headers: Sequence[Header], block: str) -> list[tuple[list[Header], str]]:
    """The metadata and the conversion record of a response record."""
    source = {name.lower(): value for name, value in reversed(headers)}
    origin = source.get("warc-record-id") or named("unnamed", block)
    http, cut, payload = block.partition(END + END)
    if not cut:
        http, payload = "", block
    status, *http_headers = http.split(END) if http else [""]
    text, title, language, links = plain(payload)
    url, date = source.get("warc-target-uri"), source.get("warc-date")
    about, converted = named("metadata", origin), named("conversion", origin)
    payload_digest = source.get("warc-payload-digest") or digest(payload.encode("utf-8"))
    block_digest = source.get("warc-block-digest") or digest(block.encode("utf-8"))
    linked = [("WARC-Refers-To", origin)]
    linked += [("WARC-Refers-To-Target-URI", url)] if url else []
    linked += [("WARC-Refers-To-Date", date)] if date else []
    fields = [("title", title)] * bool(title) + [("language", language)] * bool(language)
    fields += [("source-status", status)] * bool(status)
    fields += [("source-header", line) for line in http_headers if line]
    fields += [("source-block-digest", block_digest), ("source-payload-digest", payload_digest),
               ("source-length", str(len(payload.encode("utf-8")))), ("conversion", converted)]
    fields += [("outlink", link) for link in links if link.strip()]
    described = "".join(f"{name}: {_one_line(value)}{END}" for name, value in fields)
    return [
        _record("metadata", about, date, url, [("Content-Type", "application/warc-fields"), *linked,
                                               ("WARC-Concurrent-To", converted)], described),
        _record("conversion", converted, date, url, [("Content-Type", "text/plain; charset=utf-8"), *linked,
                                                     ("WARC-Concurrent-To", about),
                                                     ("WARC-Source-Payload-Digest", payload_digest)], text),
    ]


def responses(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", page: str = "html",
              media: str = "text/html; charset=utf-8", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Response records of fetched pages: the ``keep`` columns, ``headers`` and ``block``.

    A null page has an empty payload; a null url leaves the target out. Rows equal in id, url and
    page are one record and have one record id. Kept columns named like an output are replaced.
    """

    def make():
        def compute(columns):
            ids, urls, bodies = (c.to_pylist() for c in columns)
            made = [response(i or "", u, b or "", date, media) for i, u, b in zip(ids, urls, bodies, strict=True)]
            return [[_pairs(h) for h, _ in made], [b for _, b in made]]
        return compute

    names = [f"k{i}" for i in range(len(keep))]
    frame = pages.select(*[column(pages, c).alias(n) for c, n in zip(keep, names, strict=True)],
                         column(pages, page_id).cast("string").alias("id"), column(pages, url).alias("url"),
                         column(pages, page).alias("page"))
    made = append(frame, ["id", "url", "page"], f"headers {HEADERS}, block string", make, keep=names)
    left = kept(keep, ("headers", "block"))
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True) if c in left], "headers", "block")


def _pairs(headers: Sequence[Header]) -> list[dict[str, str]]:
    return [{"name": name, "value": value} for name, value in headers]


def _header(name: str) -> Column:
    """The value of the first header of that lower-case name; null if there is none."""
    return F.expr(f"get(filter(headers, h -> lower(h.name) = '{name}'), 0).value")


def derive(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Two records for each response among ``records`` (``headers``, ``block``): metadata and conversion.

    Records of other types give nothing; headers or a block that are null count as empty, and
    headers without a type as another type. Returns the ``keep`` columns, ``headers`` and ``block``.
    """
    kind = _header("warc-type")

    def make():
        def compute(columns):
            made = []
            for headers, block in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
                pairs = [(h["name"], h["value"] or "") for h in headers if h and h["name"]]
                made.append([{"headers": _pairs(h), "block": b} for h, b in derivatives(pairs, block or "")])
            return [made]
        return compute

    names = [f"k{i}" for i in range(len(keep))]
    frame = records.filter(kind == "response").select(
        *[column(records, c).alias(n) for c, n in zip(keep, names, strict=True)], "headers", "block")
    made = append(frame, ["headers", "block"], f"made array<struct<headers:{HEADERS},block:string>>", make, keep=names)
    left = kept(keep, ("headers", "block"))
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True) if c in left],
                       F.explode("made").alias("made")).select(*left, "made.headers", "made.block")


def flatten(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns and the usual headers of each record as columns, null where one is absent."""
    fields = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
              "concurrent_to": "WARC-Concurrent-To", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
              "content_type": "Content-Type", "source_payload_digest": "WARC-Source-Payload-Digest",
              "block_digest": "WARC-Block-Digest"}
    taken = [_header(name.lower()).alias(c) for c, name in fields.items()]
    left = kept(keep, (*fields, "content_length", "block"))
    return records.select(*[column(records, c) for c in left], *taken,
                          F.octet_length("block").cast("long").alias("content_length"), "block")


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records (``headers``, ``block``) as WARC files, one for each partition."""
    lines = F.expr(f"concat_ws('{END}', transform(headers, h -> concat(h.name, ': ', h.value)))".replace("\r\n", "\\r\\n"))
    whole = F.concat(F.lit(VERSION + END), lines, F.lit(END + END), F.col("block"))
    records.select(whole.alias("value")).write.option("lineSep", END + END).option("compression", compression).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records (``headers``, ``block``) of WARC files whose blocks are text.

    Fails on a record whose length is not the one it states (a block may not hold the beginning of
    another record); files are never cut inside a record.
    """
    mark = END + END + VERSION + END
    raw = spark.read.option("lineSep", mark).text(path).filter("trim(value) != ''")
    # Only a file's first record still has its version line, only the last its end.
    raw = raw.select(F.regexp_replace("value", r"^WARC/1\.[01]\r\n", "").alias("value"))
    at = F.instr("value", END + END)
    head = F.substr(F.col("value"), F.lit(1), at - 1)
    pair = F.expr(r"transform(split(head, '\r\n'), x -> struct(substring_index(x, ':', 1) as name, "
                  r"ltrim(substr(x, instr(x, ':') + 1)) as value))")
    split = raw.select(head.alias("head"), F.substr(F.col("value"), at + 4).alias("rest")).select(pair.alias("headers"), "rest")
    stated = _header("content-length").cast("long")
    block = F.when(F.octet_length("rest") == stated, F.col("rest")).when(
        (F.octet_length("rest") == stated + 4) & F.col("rest").endswith(END + END),
        F.expr("substr(rest, 1, length(rest) - 4)"))
    wrong = F.raise_error(F.lit("a WARC record is not as long as it states"))
    return split.select("headers", F.coalesce(block, wrong.cast("string")).alias("block"))
